"""Own-brand forecasts: completion, share preparation and allocation to branch plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import PlanContext, own_brand_steps
from salesloom.functions import ratio
from salesloom.operators.allocation import first_passing, with_retries
from salesloom.operators.stretch import stretched, total_of, with_plan
from salesloom.operators.wallet import recode_branches
from salesloom.session import stage

# --- fixed values: bands of the ratchet over the own-brand share ---
RATCHET_END = 97
RATCHET_WIDTH = 0.009999
FIRST_STEP_OFFSET = 0.001
SMALL_TARGET = 500.0
# --------------------------------------------------------------------
KEY = ("sale_loc", "level")
DECISION = (*KEY, "plan", "stage", "factor", "stop_band")


def fill_missing_clients(
    own_forecast: DataFrame, entire_plan: DataFrame, branches: DataFrame, ctx: PlanContext
) -> DataFrame:
    """Add the clients of the entire plan that have no own-brand forecast, and the branch.

    An added client gets the own-brand threshold, or its entire target where that is at most 1.
    """
    entire_target = F.col("target").cast("double")
    added = (
        entire_plan.select("segment", "target")
        .join(own_forecast.select("segment"), "segment", "left_anti")
        .select(
            "segment",
            F.when(entire_target > 1, F.lit(ctx.own_brand_low_value)).otherwise(entire_target).alias("target"),
        )
    )
    own = own_forecast.select("segment", F.col("target").cast("double").alias("target"))
    return own.unionByName(added).join(branches, "segment", "left")


def recent_thirds(shipments: DataFrame, ctx: PlanContext) -> DataFrame:
    """Sales of the months strictly after the churn date, divided by three and rounded down."""
    return (
        shipments.filter(F.col("month") > F.lit(ctx.churn_from))
        .groupBy("segment")
        .agg(F.floor(F.sum("target") / 3).cast("double").alias("entire_mean"))
    )


def prepare_own_brand(
    forecast: DataFrame,
    shipments: DataFrame,
    own_shipments: DataFrame,
    recode: DataFrame,
    ctx: PlanContext,
) -> DataFrame:
    """Own-brand share of the client's sales, and the bounds of its own last year."""
    t = F.col("target")
    bounds = (
        own_shipments.filter(F.col("month") > F.lit(ctx.year_from))
        .groupBy("segment")
        .agg(
            F.min("target").cast("double").alias("least"),
            F.max("target").cast("double").alias("greatest"),
        )
    )
    share_base = F.lit(ctx.own_brand_low_value / ctx.own_brand_border) * t
    joined = forecast.join(recent_thirds(shipments, ctx), "segment", "left").join(bounds, "segment", "left")
    prepared = joined.select(
        "segment",
        "target",
        "sale_loc",
        F.coalesce("entire_mean", share_base).alias("entire_mean"),
        F.coalesce(ratio(t, F.col("entire_mean")), F.lit(1.0)).alias("rel"),
        F.coalesce("least", t).alias("least"),
        F.coalesce("greatest", t).alias("greatest"),
    )
    return recode_branches(prepared, recode)


def border_value(border: float) -> str:
    """Clients below the border share rise to it, at most to their own greatest month."""
    lifted = f"coalesce(try_divide({border!r}D, rel) * target, target)"
    return f"if(rel < {border!r}D, least({lifted}, greatest), target)"


def ratchet_bands(border: float) -> list[int]:
    """Band numbers in hundredths, from the border share up."""
    return list(range(int(border * 100), RATCHET_END))


def ratchet_path(border: float) -> str:
    """Share after each ratchet band, as an array; a client lifted once may be lifted again.

    Sequential within the row only, so a fold over the fixed bands gives all states. Small
    clients below the border start as if they were whole.
    """
    bands = ratchet_bands(border)
    start = f"if(rel < {border!r}D and target <= {SMALL_TARGET!r}D, 1D, rel)"
    # the first band starts slightly above the border
    factor = f"if(n = {bands[0]}, {border + FIRST_STEP_OFFSET!r}D, n / 100)"
    inside = f"state.rel between {factor} and {factor} + {RATCHET_WIDTH!r}D and target > {SMALL_TARGET!r}D"
    moved = f"if({inside}, {factor} + step, state.rel)"
    return f"""aggregate(
        sequence({bands[0]}, {bands[-1]}),
        named_struct('rel', {start}, 'path', cast(array() as array<double>)),
        (state, n) -> named_struct('rel', {moved}, 'path', array_append(state.path, {moved})),
        state -> state.path
    )"""


def share_value(share: str, keep_border_fill: bool, border: float) -> str:
    """Target of a share: no base means the target stays; never above the greatest month."""
    value = f"least(if(entire_mean = 0D, target, {share} * entire_mean), greatest)"
    return f"greatest({value}, {border_value(border)})" if keep_border_fill else value


def _border_decisions(planned: DataFrame, border: float) -> DataFrame:
    sums = planned.groupBy("sale_loc", "plan").agg(
        F.expr(f"double({total_of('target')}) as total"),
        F.expr(f"double({total_of(border_value(border))}) as border_total"),
    )
    return sums.withColumn(
        "stage",
        F.expr(
            "case when try_divide(plan, total) < 1 then 'scale' "
            "when border_total > plan then 'border' else 'open' end"
        ),
    ).selectExpr(
        "sale_loc",
        "plan",
        "stage",
        "case stage when 'scale' then try_divide(plan, total) "
        "when 'border' then try_divide(plan - total, border_total - total) end as factor",
    )


def _border_target(border: float) -> str:
    filled = stretched("target", border_value(border))
    return f"case stage when 'scale' then target * factor when 'border' then {filled} else target end"


def border_fill(rows: DataFrame, plans: DataFrame, border: float) -> DataFrame:
    """Scale-down or border fill of each branch; ``open`` marks branches it does not suffice for."""
    planned = with_plan(rows, plans)
    decisions = stage(_border_decisions(planned, border), "own-border")
    found = planned.join(decisions.drop("plan"), "sale_loc")
    return found.select("segment", "sale_loc", "stage", F.expr(_border_target(border)).alias("target"))


def _with_path(rows: DataFrame, border: float, steps: Sequence[float]) -> DataFrame:
    """Share path of each row for the parameter level it names."""
    step = F.expr(f"get(array({', '.join(f'{s!r}D' for s in steps)}), level) as step")
    return rows.select("*", step).withColumn("path", F.expr(ratchet_path(border)))


def ratchet_decisions(
    planned: DataFrame,
    border: float,
    steps: Sequence[float],
    levels: Sequence[int],
    keep_border_fill: bool = False,
) -> DataFrame:
    """First ratchet band that lifts the branch above its plan, per branch and level."""
    leveled = planned.withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    every = _with_path(leveled, border, steps).select("*", F.expr("posexplode(path) as (pos, share)"))
    sums = every.groupBy(*KEY, "plan", "pos").agg(
        F.expr(f"double({total_of('target')}) as total"),
        F.expr(f"double({total_of(share_value('share', keep_border_fill, border))}) as raised"),
    )
    branches = sums.groupBy(*KEY, "plan").agg(
        F.expr("min(if(raised > plan, struct(pos, raised, total), null)) as stop")
    )
    return branches.selectExpr(
        *KEY,
        "plan",
        "if(stop is not null, 'ratchet', 'failed') as stage",
        "try_divide(plan - stop.total, stop.raised - stop.total) as factor",
        f"stop.pos + {ratchet_bands(border)[0]} as stop_band",
    )


def ratchet_fill(
    rows: DataFrame, plans: DataFrame, border: float, step: float, keep_border_fill: bool = False
) -> DataFrame:
    """The ratchet alone on every branch; without a passing band all bands are taken."""
    planned = with_plan(rows, plans)
    decisions = stage(ratchet_decisions(planned, border, [step], [0], keep_border_fill), "own-ratchet")
    found = _with_path(planned.join(decisions.drop("plan"), "sale_loc"), border, [step])
    return found.withColumn("_new", F.expr(_ratchet_target(border, keep_border_fill))).selectExpr(
        "segment", "sale_loc", "stage = 'ratchet' as passed", "stop_band", "_new as target"
    )


def _ratchet_target(border: float, keep_border_fill: bool) -> str:
    """New target under a ratchet decision: the share at the stop band, or at the last band."""
    bands = ratchet_bands(border)
    reached = f"get(path, if(stage = 'ratchet', stop_band, {bands[-1]}) - {bands[0]})"
    value = share_value(reached, keep_border_fill, border)
    return f"if(stage = 'ratchet', {stretched('target', value)}, {value})"


def own_brand_decisions(
    planned: DataFrame, border: float, steps: Sequence[float], keep_border_fill: bool = False
) -> DataFrame:
    """One decision per branch: scale-down, border fill, or the first ratchet level that passes.

    Scale-down and border fill do not depend on the level, so only the ratchet has levels: the first
    for all open branches, the others, at once, for those it leaves below their plan.
    """
    first = stage(_border_decisions(planned, border), "own-border")
    done = first.filter("stage <> 'open'").selectExpr(
        "sale_loc", "0 as level", "plan", "stage", "factor", "cast(null as int) as stop_band"
    )
    open_branches = first.filter("stage = 'open'").select("sale_loc")
    if open_branches.isEmpty():
        return done

    def tried(left: DataFrame, levels: Sequence[int]) -> DataFrame:
        found = ratchet_decisions(left, border, steps, levels, keep_border_fill)
        return stage(first_passing(found.select(*DECISION)), "own-ratchet")

    rows = planned.join(open_branches, "sale_loc", "left_semi")
    first_level = tried(rows, [0])
    retries = range(1, len(steps))
    if retries:
        first_level = with_retries(rows, first_level, lambda left: tried(left, retries))
    return done.unionByName(first_level)


def allocate_own_brand(
    prepared: DataFrame,
    plans: DataFrame,
    ctx: PlanContext,
    steps: Sequence[float] | None = None,
    keep_border_fill: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Own-brand targets that meet the branch plans, and the decision table.

    Pass a staged ``prepared``. A branch no step suffices for keeps the values of the last
    ratchet band of the last level. Clients without a branch plan keep their forecast.
    """
    steps = list(steps or own_brand_steps())
    border = ctx.own_brand_border
    planned = with_plan(prepared, plans)
    decisions = own_brand_decisions(planned, border, steps, keep_border_fill)
    keyed = planned.join(decisions.drop("plan"), "sale_loc")

    by_path = F.col("stage").isin("ratchet", "failed")
    direct = keyed.filter(~by_path).withColumn("_new", F.expr(_border_target(border)))
    late = _with_path(keyed.filter(by_path), border, steps).withColumn(
        "_new", F.expr(_ratchet_target(border, keep_border_fill))
    )
    unplanned = prepared.join(plans.select("sale_loc"), "sale_loc", "left_anti").selectExpr(
        "*", "target as _new", "cast(null as int) as level", "'no_plan' as stage"
    )

    def out(df: DataFrame) -> DataFrame:
        rel = "try_divide(_new, entire_mean) as rel"
        return df.selectExpr("segment", "_new as target", "sale_loc", "entire_mean", rel, "level", "stage")

    return out(direct).unionByName(out(late)).unionByName(out(unplanned)), decisions
