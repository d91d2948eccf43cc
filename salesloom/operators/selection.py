"""Choice of one forecast per client, and the report on that choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.context import BOOSTING_MODELS, SMA_FALLBACK, PlanContext, shift_months
from salesloom.functions import absolute_percentage_error, blended_error, exact_quantiles, ratio, whole


def selection_facts(panel: DataFrame, ctx: PlanContext) -> DataFrame:
    """Least and greatest month after the year start, and the holdout month's sales.

    Months missing between a client's first and last one count as zero. Comparing the months
    seen with the months spanned tells whether there are any, so no gap is filled for this.
    """
    sales = F.coalesce("target", F.lit(0))
    start = shift_months(ctx.year_from, 1)
    in_year, held_out = F.col("month") >= F.lit(start), F.col("month") == F.lit(ctx.holdout)
    seen = panel.groupBy("segment").agg(
        F.greatest(F.min("month"), F.lit(start)).alias("_from"),
        F.max("month").alias("_to"),
        F.count_if(in_year).alias("_seen"),
        F.min(F.when(in_year, sales)).alias("_min"),
        F.max(F.when(in_year, sales)).alias("_max"),
        F.coalesce(F.sum(F.when(held_out, sales)), F.lit(0)).alias("actual"),
    )
    gaps = F.col("_seen") < F.months_between("_to", "_from") + 1
    return seen.select(
        "segment",
        F.when(gaps, F.least("_min", F.lit(0))).otherwise(F.col("_min")).alias("least"),
        F.when(gaps, F.greatest("_max", F.lit(0))).otherwise(F.col("_max")).alias("greatest"),
        "actual",
    )


def _usable(ratio_models: Sequence[str]) -> Column:
    drift = ratio(F.col("hd_preds"), F.col("final_preds"))
    return (
        (F.col("final_preds") != 0)
        & (F.col("hd_preds") != 0)
        & (~F.col("model").isin(*ratio_models) | drift.between(0.25, 1.75))
        & F.col("final_preds").between(F.col("least"), F.col("greatest") * F.lit(0.95))
    )


def choose_models(
    scores: DataFrame,
    facts: DataFrame,
    ratio_models: Sequence[str] = BOOSTING_MODELS,
    fallback: str = SMA_FALLBACK,
) -> DataFrame:
    """Per client the usable forecast of least blended error, else the fallback model's.

    Ties go to the smaller holdout error, then to the model name. One aggregate finds both the
    best and the fallback row.
    """
    rated = (
        scores.join(facts, "segment", "left")
        .withColumn("actual", F.coalesce("actual", F.lit(0)))
        .withColumn("mae_hd", F.abs(F.col("actual") - F.col("hd_preds")))
        .withColumn("error", blended_error(F.col("mae"), F.col("mae_hd")))
        .withColumn("usable", F.coalesce(_usable(ratio_models), F.lit(False)))
    )
    ranked = F.struct("error", "mae_hd", "model", "hd_preds", "final_preds", "actual")
    spare = F.when(F.col("model") == fallback, F.col("final_preds"))
    return (
        rated.groupBy("segment")
        .agg(F.min(F.when(F.col("usable"), ranked)).alias("best"), F.max(spare).alias("spare"))
        .select(
            "segment",
            F.col("best.model").alias("model"),
            F.col("best.hd_preds").alias("hd_preds"),
            F.col("best.actual").alias("actual"),
            whole(F.coalesce("best.final_preds", "spare")).alias("target"),
        )
        .filter("target is not null")
    )


def model_mix(chosen: DataFrame) -> DataFrame:
    """Share of each model among the clients a model was chosen for."""
    counts = chosen.filter("model is not null").groupBy("model").agg(F.count("*").alias("clients"))
    # one row per model, so a window over all of them is small
    return counts.withColumn("share", F.col("clients") / F.sum("clients").over(Window.partitionBy()))


def score_summary(chosen: DataFrame) -> DataFrame:
    """Median, mean and deviation of the holdout percentage error where sales were positive.

    Pass a staged table: the exact median reads it several times.
    """
    scored = chosen.filter("model is not null and actual > 0").select(
        absolute_percentage_error(F.col("actual"), F.col("hd_preds")).alias("score")
    )
    median = exact_quantiles(scored, "score", [0.5])[0]
    return scored.agg(F.avg("score").alias("mean_score"), F.stddev_samp("score").alias("std_score")).select(
        F.lit(median).alias("median_score"), "mean_score", "std_score"
    )
