"""Filtered and joined views of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import ACTIVE_STATUS, PLAN_VALUE_COLUMN, SHIPMENT_OPERATION, PlanContext
from salesloom.functions import clean_manager, whole


def shipment_lines(shipments: DataFrame, ctx: PlanContext) -> DataFrame:
    """Lines in the history range, of shipment type and with a client.

    The range is a test on the raw day: history starts on a month start and ends on a month
    end, so testing the month start instead would keep the same lines but defeat pushdown.
    """
    return shipments.filter(
        F.col("ordered_day").between(F.lit(ctx.history_start), F.lit(ctx.history_end))
        & (F.col("oper_tp_id") == SHIPMENT_OPERATION)
        & F.col("site_use_id").isNotNull()
    )


def marked_lines(shipments: DataFrame, products: DataFrame, ctx: PlanContext) -> DataFrame:
    """All shipment lines with ``own_brand``, whether the product is of the own brand."""
    code = whole(F.col("medicine_code")).alias("_own")
    own = products.filter("own_mark = 1").select(code).filter("_own is not null").distinct()
    lines = shipment_lines(shipments, ctx)
    marked = lines.join(own, whole(lines["cd_m"]) == own["_own"], "left")
    return marked.withColumn("own_brand", F.col("_own").isNotNull()).drop("_own")


def own_brand_lines(shipments: DataFrame, products: DataFrame, ctx: PlanContext) -> DataFrame:
    own = products.filter("own_mark = 1").select(whole(F.col("medicine_code")).alias("_code"))
    lines = shipment_lines(shipments, ctx).withColumn("_code", whole(F.col("cd_m")))
    return lines.join(own, "_code", "left_semi").drop("_code")


def client_cards(
    plan_links: DataFrame, customers: DataFrame, partners: DataFrame, ctx: PlanContext
) -> DataFrame:
    """One card per client site of the previous plan period.

    Status filters sit on the joined sides, so both joins keep matches only. A site may come
    several times: turnover is averaged over its rows and the greatest row is kept.
    """
    links = plan_links.filter(F.col("plan_period") == F.lit(ctx.card_period))
    billing = customers.filter(F.col("bill_status") == ACTIVE_STATUS)
    sites = partners.filter(
        (F.col("site_status") == ACTIVE_STATUS) & (F.col("activity") == F.lit(ctx.activity))
    ).withColumn("manager", clean_manager(F.col("manager")))
    joined = links.join(billing, "customers").join(
        sites, links["site_id_link"] == sites["site_use_id"]
    )
    own = [c for c in joined.columns if c not in ("site_id_link", "turnover")]
    first = [c for c in ("value", "customers") if c in own]
    ordered = first + [c for c in own if c not in first]
    return (
        joined.groupBy("site_id_link")
        .agg(F.avg("turnover").alias("turnover"), F.max(F.struct(*ordered)).alias("kept"))
        .select("site_id_link", "turnover", "kept.*")
    )


def branch_plans_for(branch_plans: DataFrame, plan_type: str, ctx: PlanContext) -> DataFrame:
    """Branch plans of the plan month, one row per branch; the value column follows the plan type.

    Of several rows of a branch the one with the greatest value counts.
    """
    value = F.max(PLAN_VALUE_COLUMN[plan_type]).alias("plan_value")
    of_month = branch_plans.filter(F.col("plan_month") == F.lit(ctx.plan_month))
    return of_month.groupBy("sale_loc", "plan_month").agg(value)


def client_branches(site_branch: DataFrame) -> DataFrame:
    """Last known branch of each client; the name breaks ties of the date."""
    return (
        site_branch.filter("segment is not null and sale_loc is not null")
        .groupBy("segment")
        .agg(F.max(F.struct("updated", "sale_loc"))["sale_loc"].alias("sale_loc"))
    )
