"""The plan for all goods."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from salesloom.context import AllocationLevel, PlanContext
from salesloom.operators.allocation import allocate, branch_status, client_year
from salesloom.operators.boosting import Family, fit_families
from salesloom.operators.moving_average import moving_average_scores
from salesloom.operators.panel import own_months
from salesloom.operators.segments import class_forecasts, with_segment_class
from salesloom.operators.selection import choose_models, model_mix, score_summary, selection_facts
from salesloom.operators.wallet import wallet_share
from salesloom.plans.panels import active_panel, cards_of, load_months
from salesloom.session import stage
from salesloom.sources.loaders import branch_plans_for, client_branches
from salesloom.sources.tables import Sources

# (classed panel, cards, sources, context) -> score tables like those of the moving averages, or fits
ModelFamilies = Callable[[DataFrame, DataFrame, Sources, PlanContext], Sequence]


@dataclass(frozen=True)
class PlanResult:
    """Allocated targets, their detail, the forecast they come from, the branch outcomes, and the report
    on the models: chosen per client, their shares, the score summary, importances and search trials.
    """

    result: DataFrame
    raw: DataFrame
    forecast: DataFrame
    status: DataFrame
    panel: DataFrame
    own_panel: DataFrame
    cards: DataFrame
    chosen: DataFrame
    mix: DataFrame
    summary: DataFrame
    importances: DataFrame | None = None
    trials: DataFrame | None = None


def boosted(families: Sequence[Family], shift: int = 1) -> ModelFamilies:
    """Model families to pass to :func:`entire_plan`: one boosted model per client cluster."""

    def fitted(classed: DataFrame, cards: DataFrame, sources: Sources, ctx: PlanContext) -> list:
        return fit_families(active_panel(classed), cards, sources.calendar, families, ctx, shift)

    return fitted


def chosen_models(classed: DataFrame, ctx: PlanContext, extra_scores: Sequence[DataFrame] = ()) -> DataFrame:
    """Model and forecast of each active client."""
    active = classed.filter("segment_class = 'active'")
    # both count months without a row as zero, so the gaps need no filling
    scores, facts = moving_average_scores(active, ctx), selection_facts(active, ctx)
    for extra in extra_scores:
        scores = scores.unionByName(extra.select(*scores.columns))
    return choose_models(scores, facts)


def client_forecast(
    classed: DataFrame, ctx: PlanContext, low: float, chosen: DataFrame | None = None
) -> DataFrame:
    """Model forecast of active clients and class forecast of the others."""
    chosen = chosen_models(classed, ctx) if chosen is None else chosen
    others = class_forecasts(classed, ctx, low)
    return chosen.select("segment", chosen["target"].cast("double").alias("target")).unionByName(others)


def entire_plan(
    ctx: PlanContext,
    sources: Sources,
    families: ModelFamilies | None = None,
    levels: Sequence[AllocationLevel] | None = None,
    strict_bands: bool = True,
) -> PlanResult:
    """Forecast every client and stretch the forecasts to the branch plans.

    ``families`` returns score tables, or fits as those of :func:`boosted`, whose importances and
    search trials then are part of the result.
    """
    cards = stage(cards_of(sources, ctx), "cards")
    # only the boosted families use more than the sales of a month
    months = stage(load_months(sources, ctx, cards, averages=bool(families)), "months")
    panel = months.drop("own_target", "own_lines")
    classed = stage(with_segment_class(panel, ctx, ctx.low_value), "entire-panel")
    fits = list(families(classed, cards, sources, ctx)) if families else []
    scores = [fit if isinstance(fit, DataFrame) else fit.scores for fit in fits]
    reports = [fit for fit in fits if not isinstance(fit, DataFrame)]
    chosen = stage(chosen_models(classed, ctx, scores), "entire-models")
    forecast = client_forecast(classed, ctx, ctx.low_value, chosen)
    wallet = stage(
        wallet_share(forecast, cards, client_branches(sources.site_branch), sources.branch_recode),
        "entire-wallet",
    )
    plans = stage(branch_plans_for(sources.branch_plans, "entire", ctx), "entire-plans")
    years = stage(client_year(classed.filter("segment_class in ('active', 'rare')"), ctx), "entire-years")
    raw, decisions = allocate(wallet, plans, years, levels, strict_bands)
    raw = stage(raw, "entire-raw")
    return PlanResult(
        result=raw.select("segment", "target", "sale_loc"),
        raw=raw,
        forecast=wallet,
        status=branch_status(raw, decisions),
        panel=classed,
        own_panel=own_months(months),
        cards=cards,
        chosen=chosen,
        mix=model_mix(chosen),
        summary=score_summary(chosen),
        importances=_together([fit.importances for fit in reports]),
        trials=_together([fit.trials for fit in reports]),
    )


def _together(tables: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, tables) if tables else None
