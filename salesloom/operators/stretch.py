"""Expressions of the stretch stages, and single stages over all branches.

The stages are many small formulas over the same columns, so they are built as SQL text and
parsed by one ``expr`` call each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import AllocationLevel
from salesloom.session import stage

STAGES = ("very_low", "to_5", "to_10", "to_15", "to_20", "to_25")
# --- fixed values: share-of-wallet bands and the parameter that lifts each of them ---
BANDS = (
    (0.05, "to_5"),
    (0.1, "to_10"),
    (0.15, "to_15"),
    (0.2, "to_20"),
    (0.25, "to_25"),
)
VERY_LOW_BELOW = 0.01
FIRST_BAND, LAST_BAND = 25, 98
FIRST_BAND_FROM = 0.250001
BAND_WIDTH = 0.009999
# -------------------------------------------------------------------------------------
SUM_TYPE = "decimal(28,9)"


def total_of(value: str) -> str:
    """Sum that does not depend on row order, so plan comparisons repeat exactly."""
    return f"sum(cast({value} as {SUM_TYPE}))"


def _parameters(level: AllocationLevel) -> str:
    values = ", ".join(
        f"{value} as {name}" if name == "level" else f"{value!r}D as {name}"
        for name, value in asdict(level).items()
    )
    return f"struct({values})"


def with_levels(rows: DataFrame, levels: Sequence[AllocationLevel]) -> DataFrame:
    """One copy of each row per parameter level, with the parameters in ``lvl``."""
    every = ", ".join(map(_parameters, levels))
    return rows.withColumn("lvl", F.expr(f"explode(array({every}))")).withColumn("level", F.col("lvl.level"))


def with_own_level(rows: DataFrame, levels: Sequence[AllocationLevel]) -> DataFrame:
    """The parameters of the level each row already names, in ``lvl``."""
    cases = " ".join(f"when {level.level} then {_parameters(level)}" for level in levels)
    return rows.withColumn("lvl", F.expr(f"case level {cases} end"))


def current_share(target: str, turnover: str = "soz") -> str:
    return f"coalesce(try_divide({target}, {turnover}), 1D)"


def is_big(target: str, share: str) -> str:
    return f"({target} > lvl.big_target and {share} > lvl.big_share)"


def raised_share(share: str, step: str, strict_bands: bool = True) -> str:
    """Share of wallet after a stage: every band up to the stage's own is lifted.

    Bands are half-open. With ``strict_bands`` the fifth stage lifts no more than the fourth.
    """
    reach = STAGES.index(step)
    if step == "to_20" and strict_bands:
        reach = STAGES.index("to_15")
    cases = [f"when {share} < 0D then {share}", f"when {share} < {VERY_LOW_BELOW!r}D then {share} * lvl.very_low"]
    # a parameter above the cap would lift a client past the band it is headed for
    cases += [f"when {share} < {b!r}D then {_capped(share, f'lvl.{name}')}" for b, name in BANDS[:reach]]
    return f"(case {' '.join(cases)} else {share} end)"


def _capped(share: str, value: str) -> str:
    return f"if({share} < lvl.cap, least({value}, lvl.cap), {value})"


def stage_value(step: str, strict_bands: bool = True) -> str:
    """Client target after a share stage."""
    return f"({raised_share('share', step, strict_bands)} * soz)"


def band_start(number: str) -> str:
    return f"if({number} = {FIRST_BAND}, {FIRST_BAND_FROM!r}D, {number} / 100)"


def band_of(share: str) -> str:
    """Number of the upper band (25..98) a share lies in, else NULL."""
    floor = f"int(floor({share} * 100))"
    number = f"({floor} + if({share} >= ({floor} + 1) / 100, 1, 0))"
    inside = f"{share} between {band_start(number)} and {band_start(number)} + {BAND_WIDTH!r}D"
    return f"if({number} between {FIRST_BAND} and {LAST_BAND} and {inside}, {number}, null)"


def stretched(base: str, raised: str) -> str:
    """Move a base toward the raised value by the branch's factor (none leaves the base)."""
    return f"({base} + ({raised} - {base}) * coalesce(factor, 0D))"


def with_plan(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows of branches that have a plan, with the plan value."""
    return rows.join(plans.select("sale_loc", F.col("plan_value").alias("plan")), "sale_loc")


def _fill(rows: DataFrame, raised: str, passes: str) -> DataFrame:
    """Stretch all rows of the branches that pass; others keep their target."""
    sums = stage(
        rows.groupBy("sale_loc", "plan").agg(
            F.expr(f"double({total_of('target')}) as total"),
            F.expr(f"double({total_of(raised)}) as raised_total"),
        ),
        "branch-sums",
    )
    decided = sums.select(
        "sale_loc",
        F.expr(f"coalesce({passes}, false) as passed"),
        F.expr(f"if({passes}, try_divide(plan - total, raised_total - total), null) as factor"),
    )
    return rows.join(decided, "sale_loc").select(
        "segment", "sale_loc", "passed", F.expr(stretched("target", raised)).alias("target")
    )


def _prepared(rows: DataFrame, plans: DataFrame, level: AllocationLevel) -> DataFrame:
    share = F.expr(current_share("target"))
    return with_levels(with_plan(rows, plans).withColumn("share", share), [level])


def stretch_stage(
    rows: DataFrame,
    plans: DataFrame,
    step: str,
    level: AllocationLevel = AllocationLevel(level=0),
    strict_bands: bool = True,
) -> DataFrame:
    """One of the six share stages on every branch."""
    return _fill(_prepared(rows, plans, level), stage_value(step, strict_bands), "raised_total > plan")


def fill_big_clients(
    rows: DataFrame,
    plans: DataFrame,
    level: AllocationLevel = AllocationLevel(level=0),
    finish: bool = False,
) -> DataFrame:
    """Give the gap to the big clients of the branch in proportion.

    At the start the gap must be small against the big clients, at the finish against the plan.
    """
    raised = f"if({is_big('target', 'share')}, target * 2, target)"
    gap = "try_divide(plan - total, raised_total - total)"
    start = f"({gap} > 0 and {gap} < {level.init_gap!r}D)"
    end = f"(1D - try_divide(total, plan) <= {level.big_gap!r}D)"
    return _fill(_prepared(rows, plans, level), raised, end if finish else start)


def scale_down(
    rows: DataFrame, plans: DataFrame, level: AllocationLevel = AllocationLevel(level=0)
) -> DataFrame:
    """Shrink all clients of a branch whose forecast is above the plan."""
    return _fill(_prepared(rows, plans, level), "(target * 2)", "try_divide(plan, total) < 1")
