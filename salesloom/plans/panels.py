"""Loading of the classed monthly panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesloom.context import PlanContext
from salesloom.operators.panel import fill_gaps, monthly_both, monthly_own_brand, monthly_shipments, with_card
from salesloom.operators.segments import with_segment_class
from salesloom.sources.loaders import client_cards, marked_lines, own_brand_lines, shipment_lines
from salesloom.sources.tables import Sources


def cards_of(sources: Sources, ctx: PlanContext) -> DataFrame:
    return client_cards(sources.plan_links, sources.customers, sources.partners, ctx)


def load_panel(sources: Sources, ctx: PlanContext, mode: str, cards: DataFrame | None = None) -> DataFrame:
    """Monthly panel of the clients with a card, labelled with the client class."""
    cards = cards_of(sources, ctx) if cards is None else cards
    if mode == "entire":
        panel = monthly_shipments(shipment_lines(sources.shipments, ctx))
        low = ctx.low_value
    elif mode == "own_brand":
        panel = monthly_own_brand(own_brand_lines(sources.shipments, sources.products, ctx))
        low = ctx.own_brand_low_value
    else:
        raise ValueError(f"unknown mode {mode}")
    return with_segment_class(with_card(panel, cards), ctx, low)


def load_months(sources: Sources, ctx: PlanContext, cards: DataFrame, averages: bool) -> DataFrame:
    """Monthly sales of all and of own-brand goods of the clients with a card, in one scan of the lines.

    Without ``averages`` nothing but sales is computed. Stage the result: both plans read it.
    """
    lines = marked_lines(sources.shipments, sources.products, ctx)
    months = with_card(monthly_both(lines), cards)
    return months if averages else months.select("segment", "month", "target", "own_target", "own_lines")


def sales_only(classed: DataFrame) -> DataFrame:
    """Sales and class alone: the averages and the distinct product count are never computed."""
    return classed.select("segment", "month", "target", "segment_class")


def active_panel(classed: DataFrame, target_only: bool = False) -> DataFrame:
    """Gap-filled panel of the active clients."""
    active = classed.filter("segment_class = 'active'").drop("segment_class")
    return fill_gaps(active.select("segment", "month", "target") if target_only else active)
