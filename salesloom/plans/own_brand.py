"""The plan for own-brand goods, built on the result of the entire plan."""

from __future__ import annotations

from collections.abc import Sequence

from salesloom.context import PlanContext
from salesloom.operators.allocation import branch_status
from salesloom.operators.own_brand import allocate_own_brand, fill_missing_clients, prepare_own_brand
from salesloom.operators.segments import with_segment_class
from salesloom.operators.selection import model_mix, score_summary
from salesloom.plans.entire import PlanResult, chosen_models, client_forecast
from salesloom.session import stage
from salesloom.sources.loaders import branch_plans_for, client_branches
from salesloom.sources.tables import Sources


def own_brand_plan(
    ctx: PlanContext,
    sources: Sources,
    entire: PlanResult,
    steps: Sequence[float] | None = None,
    keep_border_fill: bool = False,
) -> PlanResult:
    """Own-brand targets; the entire plan's panels and cards are used again, not reloaded."""
    classed = stage(with_segment_class(entire.own_panel, ctx, ctx.own_brand_low_value), "own-panel")
    chosen = stage(chosen_models(classed, ctx), "own-models")
    forecast = client_forecast(classed, ctx, ctx.own_brand_low_value, chosen)
    filled = fill_missing_clients(forecast, entire.result, client_branches(sources.site_branch), ctx)
    prepared = stage(
        prepare_own_brand(filled, entire.panel, classed, sources.branch_recode, ctx), "own-prepared"
    )
    plans = stage(branch_plans_for(sources.branch_plans, "own_brand", ctx), "own-plans")
    raw, decisions = allocate_own_brand(prepared, plans, ctx, steps, keep_border_fill)
    raw = stage(raw, "own-raw")
    return PlanResult(
        result=raw.select("segment", "target", "sale_loc"),
        raw=raw,
        forecast=prepared,
        status=branch_status(raw, decisions),
        panel=classed,
        own_panel=entire.own_panel,
        cards=entire.cards,
        chosen=chosen,
        mix=model_mix(chosen),
        summary=score_summary(chosen),
    )
