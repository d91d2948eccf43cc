"""Monthly job: both plans from input tables to result tables.

    python -m salesloom.plans.job --input DIR --output DIR --plan-month 2023-10-01
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from salesloom.context import PlanContext, own_brand_steps
from salesloom.operators.boosting import absolute_family, squared_family
from salesloom.operators.tuning import SearchBudget
from salesloom.operators.wallet import default_recode
from salesloom.plans.entire import boosted, entire_plan
from salesloom.plans.own_brand import own_brand_plan
from salesloom.session import build_session, drop_staged
from salesloom.sources.tables import Sources, read_plan_month, write_result


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder with one table per input schema")
    parser.add_argument("--input-format", default="parquet")
    parser.add_argument("--output", required=True)
    parser.add_argument("--output-format", default="csv")
    month = parser.add_mutually_exclusive_group(required=True)
    month.add_argument("--plan-month", help="first day of the month to plan")
    month.add_argument("--plan-month-file", help="one-row CSV with the column plan_month_fact")
    parser.add_argument("--history-start", default="2017-11-01")
    parser.add_argument("--models", choices=("sma", "boosted", "tuned"), default="tuned",
                        help="tuned searches each cluster's parameters; boosted takes the defaults; sma fits no trees")
    parser.add_argument("--default-recode", action="store_true", help="use the built-in closed branches")
    parser.add_argument("--shuffle-partitions", default="2000",
                        help="initial count; adaptive execution merges small ones")
    parser.add_argument("--loose-bands", action="store_true", help="the fifth stage has its own parameter")
    parser.add_argument("--keep-border-fill", action="store_true", help="keep the border fill in the ratchet")
    parser.add_argument("--own-brand-first-step", type=float, default=0.015)
    parser.add_argument("--shift", type=int, default=1, help="months between a row and its features' last month")
    return parser.parse_args(argv)


def run(args: argparse.Namespace) -> None:
    partitions = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": args.shuffle_partitions}
    spark = build_session("monthly-sales-plan", **partitions)
    try:
        plan(spark, args)
    finally:
        drop_staged(spark)


def plan(spark: SparkSession, args: argparse.Namespace) -> None:
    month = args.plan_month or read_plan_month(spark, args.plan_month_file)
    history = PlanContext.from_month(args.history_start).plan_month
    ctx = PlanContext.from_month(month, history_start=history)
    given = {"branch_recode": default_recode(spark)} if args.default_recode else {}
    sources = Sources.read(spark, args.input, args.input_format, **given)
    families = None
    if args.models != "sma":
        budget = SearchBudget() if args.models == "tuned" else None
        both = [absolute_family(budget=budget), squared_family(budget=budget)]
        families = boosted(both, args.shift)
    entire = entire_plan(ctx, sources, families, strict_bands=not args.loose_bands)
    steps = own_brand_steps(args.own_brand_first_step)
    own = own_brand_plan(ctx, sources, entire, steps, args.keep_border_fill)
    results = {
        "res_entire": entire.result,
        "forecast_entire": entire.forecast,
        "res_own_brand": own.result,
        "forecast_own_brand": own.forecast,
        "status_entire": entire.status,
        "status_own_brand": own.status,
        "models_entire": entire.chosen,
        "models_own_brand": own.chosen,
        "model_mix": entire.mix,
        "score_summary": entire.summary,
        "importances": entire.importances,
        "search_trials": entire.trials,
    }
    for name, table in results.items():
        if table is not None:
            write_result(table, f"{args.output}/{name}", args.output_format)


if __name__ == "__main__":
    run(parse())
