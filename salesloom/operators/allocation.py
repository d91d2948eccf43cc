"""The stage ladder: stretch client forecasts until each branch meets its plan.

All branches and parameter levels go through at once. A pass over the client rows only adds
sums per branch; the decision which stage passes is taken on that small table and applied to
the rows by one join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.context import (
    FIXED_LOW_TARGET,
    AllocationLevel,
    PlanContext,
    entire_levels,
)
from salesloom.functions import padded_sorted
from salesloom.operators.stretch import (
    FIRST_BAND,
    STAGES,
    band_of,
    band_start,
    current_share,
    is_big,
    raised_share,
    stage_value,
    stretched,
    total_of,
    with_levels,
    with_own_level,
    with_plan,
)
from salesloom.session import stage

FIRST_QUANTILE, LAST_QUANTILE = 30, 79
YEAR_MONTHS = 13
KEY = ("sale_loc", "level")
LATE_STAGES = ("quantile", "big_last", "failed")
DECISION = (*KEY, "plan", "stage", "factor", "stop_band", "stop_quantile")


def client_year(history: DataFrame, ctx: PlanContext) -> DataFrame:
    """Sorted sales of each client's 13 months up to the plan month, in ``ordered``.

    Months without a row count as zero, the plan month always does. At most 13 values per client.
    """
    year = history.filter(F.col("month").between(F.lit(ctx.year_from), F.lit(ctx.plan_month)))
    values = F.collect_list(F.coalesce(F.col("target").cast("double"), F.lit(0.0)))
    return (
        year.groupBy("segment")
        .agg(values.alias("_values"))
        .select("segment", padded_sorted(F.col("_values"), YEAR_MONTHS).alias("ordered"))
    )


def _own_quantile(percent: str) -> str:
    """Linear-interpolated quantile of the client's year; NULL for a client without one."""
    position = f"({percent} / 100 * {YEAR_MONTHS - 1})"
    low = f"int(floor({position}))"
    first, second = f"get(ordered, {low})", f"get(ordered, least({low} + 1, {YEAR_MONTHS - 1}))"
    return f"({first} + ({second} - {first}) * ({position} - {low}))"


def _every_quantile() -> str:
    return f"explode(sequence({FIRST_QUANTILE}, {LAST_QUANTILE})) as q"


def client_quantiles(year: DataFrame) -> DataFrame:
    """Quantiles .30 to .79 of each client's year, one row each."""
    return year.select("segment", "ordered", F.expr(_every_quantile())).select(
        "segment", "q", F.expr(_own_quantile("q")).alias("quantile")
    )


def _lifted(rows: DataFrame) -> DataFrame:
    """Values every stage before the quantiles needs: shares, upper band and lifted target."""
    return (
        rows.withColumn("share", F.expr(current_share("target")))
        .withColumn("base_share", F.expr(raised_share("share", "to_25")))
        .withColumns({"base": F.expr("base_share * soz"), "band": F.expr(band_of("base_share"))})
        .withColumn(
            "top_share",
            F.expr(f"if(band is not null, {band_start('band')} + lvl.band_step, base_share)"),
        )
        .withColumn("top", F.expr("top_share * soz"))
    )


def _branch_sums(rows: DataFrame, strict_bands: bool) -> DataFrame:
    """Totals of every stage before the quantiles per (branch, level).

    Rows are summed per (branch, level, upper band): at most 75 rows per branch and level, with
    partial sums on the map side, so the size of a branch does not matter. ``stop`` is the first
    band whose running total is above the plan.
    """
    added = {
        "total": "target",
        "big": f"if({is_big('target', 'share')}, target, null)",
        "base_total": "base",
        "top_total": "top",
        "top_big": f"if({is_big('top', 'top_share')}, top, null)",
    } | {f"sum_{s}": stage_value(s, strict_bands) for s in STAGES}
    cells = (
        _lifted(rows)
        .groupBy(
            *KEY,
            "plan",
            F.expr("lvl.big_gap as big_gap"),
            F.expr("lvl.init_gap as init_gap"),
            F.expr("coalesce(band, 0) as band"),
        )
        .agg(
            *[F.expr(f"{total_of(value)} as {name}") for name, value in added.items()],
            F.expr(f"{total_of('top - base')} as gain"),
        )
    )
    branch = Window.partitionBy(*KEY)
    first_gain = f"coalesce(double(sum(if(band = {FIRST_BAND}, gain, null))), 0D)"
    at_first = f"struct({FIRST_BAND} as band, max(upto_base) + {first_gain} as upto)"
    at_later = "min(if(band > 0 and upto > plan, struct(band, upto), null))"
    base, gains = F.sum("base_total").over(branch), F.sum("gain").over(branch.orderBy("band"))
    return (
        cells.withColumns({"upto_base": base.cast("double"), "upto": (base + gains).cast("double")})
        .groupBy(*KEY, "plan", "big_gap", "init_gap")
        .agg(
            *[F.expr(f"coalesce(double(sum({name})), 0D) as {name}") for name in added],
            # without a test before it, the first band already passes where the base does
            F.expr(f"if(max(upto_base) > plan, {at_first}, {at_later}) as stop"),
        )
    )


BAND_FACTOR = "try_divide(plan - base_total, stop.upto - base_total)"


def _first_decisions(rows: DataFrame, strict_bands: bool) -> DataFrame:
    """Stage reached by each branch and level without quantiles; NULL where none passes."""
    sums = _branch_sums(rows, strict_bands)
    gap = "try_divide(plan - total, big)"
    short = "1D - try_divide(top_total, plan)"
    rules = {
        "big_init": (f"{gap} > 0 and {gap} < init_gap", gap),
        "scale": ("try_divide(plan, total) < 1", "try_divide(plan, total)"),
        **{
            s: (f"sum_{s} > plan", f"try_divide(plan - total, sum_{s} - total)") for s in STAGES
        },
        "bands": ("stop is not null", BAND_FACTOR),
        "big_finish": (f"{short} <= big_gap", "try_divide(plan - top_total, top_big)"),
    }
    decided = _by_rules(sums, rules)
    return decided.selectExpr(
        *DECISION[:5], "stop.band as stop_band", "cast(null as int) as stop_quantile", "big_gap"
    )


def _by_rules(sums: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """First rule whose test holds, and its stretch factor."""
    tests = " ".join(f"when {test} then '{name}'" for name, (test, _) in rules.items())
    factors = " ".join(f"when '{name}' then {factor}" for name, (_, factor) in rules.items())
    return sums.withColumn("stage", F.expr(f"case {tests} end")).withColumn(
        "factor", F.expr(f"case stage {factors} end")
    )


def _uplifted(percent: str) -> str:
    """Lifted target raised to the client's own quantile; zero and low targets stay."""
    return f"(case when top in (0D, {FIXED_LOW_TARGET!r}D) then top else greatest(top, {_own_quantile(percent)}) end)"


# what the rows of all quantiles need of their level
BIG_RULE = "named_struct('big_target', lvl.big_target, 'big_share', lvl.big_share) as lvl"


def _quantile_sums(rows: DataFrame, years: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First quantile whose total is above the plan, and the totals of the last quantile.

    Each row is expanded to the 50 quantiles and summed at once, map side first.
    """
    raised = (
        rows.join(years, "segment", "left")
        .select(*keys, "soz", "top", "ordered", F.expr(BIG_RULE), F.expr(_every_quantile()))
        .withColumn("raised", F.expr(_uplifted("q")))
    )
    big = is_big("raised", current_share("raised"))
    sums = raised.groupBy(*keys, "q").agg(
        F.expr(f"double({total_of('raised')}) as total"),
        F.expr(f"double({total_of('top')}) as top_sum"),
        F.expr(f"double({total_of(f'if({big}, raised, null)')}) as big"),
    )
    return sums.groupBy(*keys).agg(
        F.expr("min(if(total > plan, struct(q, total), null)) as stop"),
        F.expr("max(top_sum) as top_sum"),
        F.expr("max_by(total, q) as final_total"),
        F.expr("max_by(big, q) as final_big"),
    )


QUANTILE_FACTOR = "try_divide(plan - top_sum, stop.total - top_sum)"


def _quantile_decisions(rows: DataFrame, undecided: DataFrame, years: DataFrame) -> DataFrame:
    """Decisions of the branches that no earlier stage brought to the plan."""
    open_rows = _lifted(rows.join(undecided.select(*KEY, "big_gap"), list(KEY)))
    branches = _quantile_sums(open_rows, years, (*KEY, "plan", "big_gap"))
    rules = {
        "quantile": ("stop is not null", QUANTILE_FACTOR),
        "big_last": (
            "1D - try_divide(final_total, plan) <= big_gap",
            "try_divide(plan - final_total, final_big)",
        ),
        "failed": ("true", "cast(null as double)"),
    }
    return _by_rules(branches, rules).selectExpr(
        *DECISION[:5], "cast(null as int) as stop_band", "stop.q as stop_quantile"
    )


def first_passing(decisions: DataFrame) -> DataFrame:
    """Per branch the lowest level that passes, else the last level."""
    order = F.expr("struct(stage = 'failed', if(stage = 'failed', -level, level))")
    kept = F.min_by(F.struct(*decisions.columns), order)
    return decisions.groupBy("sale_loc").agg(kept.alias("kept")).select("kept.*")


def _tried(
    rows: DataFrame, years: DataFrame, levels: Sequence[AllocationLevel], strict_bands: bool
) -> DataFrame:
    """Best of the given levels for each branch; only levels below its first early pass go on to the quantiles."""
    leveled = with_levels(rows, levels)
    first = stage(_first_decisions(leveled, strict_bands), "early-decisions")
    passing = F.min(F.expr("if(stage is not null, level, null)")).over(Window.partitionBy("sale_loc"))
    open_levels = first.withColumn("_passing", passing).filter(
        "stage is null and (_passing is null or level < _passing)"
    )
    found = first.filter("stage is not null").select(*DECISION)
    if not open_levels.isEmpty():
        open_levels = stage(open_levels.drop("_passing"), "open-levels")
        found = found.unionByName(_quantile_decisions(leveled, open_levels, years))
    return stage(first_passing(found), "branch-decisions")


def with_retries(rows: DataFrame, first: DataFrame, retry: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``first`` decisions, replaced by those of ``retry`` for the branches that failed; only their rows are tried again."""
    failed = first.filter("stage = 'failed'").select("sale_loc")
    if failed.isEmpty():
        return first
    again = retry(rows.join(failed, "sale_loc", "left_semi"))
    return first.filter("stage <> 'failed'").unionByName(again)


def branch_decisions(
    rows: DataFrame,
    years: DataFrame,
    levels: Sequence[AllocationLevel],
    strict_bands: bool = True,
) -> DataFrame:
    """Level, stage and stretch factor of each branch.

    Every level starts from the same forecast. The first is tried on all branches, the others, at once, on those it
    leaves below their plan.
    """
    first = _tried(rows, years, levels[:1], strict_bands)
    if len(levels) == 1:
        return first
    return with_retries(rows, first, lambda left: _tried(left, years, levels[1:], strict_bands))


def _by_stage(values: dict[str, str]) -> str:
    cases = " ".join(f"when '{name}' then {value}" for name, value in values.items())
    return f"case stage {cases} end"


def _early_target(strict_bands: bool) -> str:
    """New target of a row whose branch was decided before the quantiles."""

    def to_big(value: str, share: str) -> str:
        return f"if({is_big(value, share)}, {stretched(value, f'{value} * 2')}, {value})"

    return _by_stage(
        {
            "big_init": to_big("target", "share"),
            "scale": "target * factor",
            **{s: stretched("target", stage_value(s, strict_bands)) for s in STAGES},
            "bands": stretched("base", "if(band <= stop_band, top, base)"),
            "big_finish": to_big("top", "top_share"),
        }
    )


def _late_target() -> str:
    """New target of a row whose branch went on to the quantiles; ``final`` is the last one's."""
    big = is_big("final", current_share("final"))
    return _by_stage(
        {
            "quantile": stretched("top", _uplifted("stop_quantile")),
            "big_last": f"if({big}, {stretched('final', 'final * 2')}, final)",
            "failed": "final",
        }
    )


def allocate(
    wallet: DataFrame,
    plans: DataFrame,
    years: DataFrame,
    levels: Sequence[AllocationLevel] | None = None,
    strict_bands: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Client targets that meet the branch plans, and the decision table.

    ``wallet`` (see :func:`wallet_share`) and ``years`` (see :func:`client_year`) are read several
    times, so pass staged tables. Clients of a branch without a plan, or without a branch, keep
    their forecast.
    """
    levels = list(levels or entire_levels())
    rows = with_plan(wallet, plans)
    decisions = branch_decisions(rows, years, levels, strict_bands)
    lifted = _lifted(with_own_level(rows.join(decisions.drop("plan"), "sale_loc"), levels))
    by_quantile = F.col("stage").isin(*LATE_STAGES)
    early = lifted.filter(~by_quantile).withColumn("_new", F.expr(_early_target(strict_bands)))
    late = (
        lifted.filter(by_quantile)
        .join(years, "segment", "left")
        .withColumn("final", F.expr(_uplifted(str(LAST_QUANTILE))))
        .withColumn("_new", F.expr(_late_target()))
    )
    unplanned = wallet.join(plans.select("sale_loc"), "sale_loc", "left_anti").selectExpr(
        "segment", "target", "sale_loc", "soz", "fact_soz", "cast(null as int) as level", "'no_plan' as stage"
    )

    def settled(found: DataFrame) -> DataFrame:
        share = f"if(stage = 'scale', share, {current_share('_new')}) as fact_soz"
        return found.selectExpr("segment", "_new as target", "sale_loc", "soz", share, "level", "stage")

    return settled(early).unionByName(settled(late)).unionByName(unplanned), decisions


def stretch_upper_bands(
    rows: DataFrame, plans: DataFrame, level: AllocationLevel = AllocationLevel(level=0)
) -> DataFrame:
    """The upper-band stage alone on every branch; without a passing band all bands are lifted."""
    planned = with_levels(with_plan(rows, plans), [level])
    decided = stage(_branch_sums(planned, True), "band-sums").selectExpr(
        "sale_loc", "stop.band as stop_band", f"{BAND_FACTOR} as factor"
    )
    moved = stretched("base", "if(band <= stop_band, top, base)")
    return (
        _lifted(planned)
        .join(decided, "sale_loc")
        .selectExpr(
            "segment",
            "sale_loc",
            "stop_band is not null as passed",
            "stop_band",
            f"if(stop_band is null, top, {moved}) as target",
        )
    )


def uplift_to_quantiles(rows: DataFrame, plans: DataFrame, years: DataFrame) -> DataFrame:
    """The quantile stage alone on every branch; without a passing one the last is kept."""
    planned = with_levels(with_plan(rows, plans), [AllocationLevel(level=0)]).withColumn("top", F.col("target"))
    sums = stage(_quantile_sums(planned, years, ("sale_loc", "plan")), "quantile-sums")
    decided = sums.selectExpr("sale_loc", "stop.q as stop_quantile", f"{QUANTILE_FACTOR} as factor")
    found = planned.join(decided, "sale_loc").join(years, "segment", "left")
    moved = stretched("top", _uplifted("stop_quantile"))
    return found.selectExpr(
        "segment",
        "sale_loc",
        "stop_quantile is not null as passed",
        "stop_quantile",
        f"if(stop_quantile is null, {_uplifted(str(LAST_QUANTILE))}, {moved}) as target",
    )


def branch_status(result: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per branch: level, stage, outcome, allocated total and plan."""
    totals = result.groupBy("sale_loc", "stage", "level").agg(
        F.count("*").alias("clients"), F.expr(f"double({total_of('target')}) as total")
    )
    return totals.join(decisions.select("sale_loc", "plan"), "sale_loc", "left").selectExpr(
        "sale_loc", "level", "stage", "stage not in ('failed', 'no_plan') as passed", "clients", "total", "plan"
    )
