"""Monthly client panel and month grids."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from salesloom.context import MARKET_CHANNEL, PlanContext
from salesloom.functions import month_start, ratio, whole


def by_client() -> WindowSpec:
    return Window.partitionBy("segment")


def by_month() -> WindowSpec:
    return by_client().orderBy("month")


def _client_month() -> list[Column]:
    return [F.col("site_use_id").alias("segment"), month_start(F.col("ordered_day")).alias("month")]


def monthly_shipments(lines: DataFrame, *more: Column) -> DataFrame:
    """One row per client and month with sales, averages, order shares and assortment.

    ``more`` are further aggregates over the same groups.
    """

    def share(condition: Column) -> Column:
        # lines without the flag count as not flagged
        return F.count_if(condition) / F.count("*")

    return (
        lines.groupBy(*_client_month())
        .agg(
            F.sum(whole(F.col("cost_rub"))).alias("target"),
            F.avg("volume").alias("volume"),
            F.avg("weight").alias("weight"),
            F.avg("med_amn").alias("med_amn"),
            F.avg("nds_rate").alias("nds"),
            share(F.col("web_order_flag") == 1).alias("web_order_rel"),
            share(F.col("dlo_id") == MARKET_CHANNEL).alias("market_rel"),
            # a set merges before the shuffle, where a distinct count would shuffle every line by product first
            F.size(F.collect_set("cd_m")).cast("bigint").alias("position_count"),
            *more,
        )
        .withColumn("density", ratio(F.col("volume"), F.col("weight")))
    )


def monthly_both(lines: DataFrame) -> DataFrame:
    """Monthly shipments of all goods with the own brand's sales and lines, from one pass.

    ``lines`` as :func:`salesloom.sources.loaders.marked_lines` gives them.
    """
    own = F.col("own_brand")
    return monthly_shipments(
        lines,
        F.sum(F.when(own, whole(F.col("cost_rub")))).alias("own_target"),
        F.count_if(own).alias("own_lines"),
    )


def own_months(months: DataFrame) -> DataFrame:
    """The own-brand panel out of :func:`monthly_both`."""
    return months.filter("own_lines > 0").select("segment", "month", F.col("own_target").alias("target"))


def monthly_own_brand(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_client_month()).agg(F.sum(whole(F.col("cost_rub"))).alias("target"))


def with_card(panel: DataFrame, cards: DataFrame) -> DataFrame:
    """Clients that have a card. Joined after the monthly aggregate, on far fewer rows."""
    return panel.join(cards.select(F.col("site_id_link").alias("segment")), "segment", "left_semi")


def _spread(panel: DataFrame, first: Column, last: Column) -> DataFrame:
    """Stretch each row over the months up to the client's next row.

    The first row also takes the months from ``first``, the last one those up to ``last``, and
    values stay on the row's own month. One window on the client, no spine and no join.
    """
    values = [c for c in panel.columns if c not in ("segment", "month")]
    following, previous = F.lead("month").over(by_month()), F.lag("month").over(by_month())
    spans = panel.withColumns(
        {
            "_from": F.when(previous.isNull(), first).otherwise(F.col("month")),
            "_to": F.when(following.isNull(), last).otherwise(F.add_months(following, -1)),
        }
    )
    grid = spans.withColumn("_month", F.explode(F.sequence("_from", "_to", F.expr("interval 1 month"))))
    own = F.col("_month") == F.col("month")
    return grid.select(
        "segment",
        F.col("_month").alias("month"),
        *[F.when(own, F.col(c)).alias(c) for c in values],
    )


def _zero_filled(df: DataFrame) -> DataFrame:
    values = [f for f in df.schema if f.name not in ("segment", "month")]
    return df.withColumns(
        {f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)) for f in values}
    )


def fill_gaps(panel: DataFrame) -> DataFrame:
    """Zero rows for the months without sales between a client's first and last month."""
    return _zero_filled(_spread(panel, F.col("month"), F.col("month")))


def common_grid(panel: DataFrame, fill_zero: bool = False) -> DataFrame:
    """Every client on every month seen for any client; NULL (or 0) where it has no row."""
    bounds = panel.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    first, last = bounds.select("a").scalar(), bounds.select("b").scalar()
    grid = _spread(panel, first, last)
    return _zero_filled(grid) if fill_zero else grid


def extend_to(panel: DataFrame, last: date) -> DataFrame:
    """NULL rows for the months between a client's last month and ``last``."""
    return _spread(panel, F.col("month"), F.greatest(F.col("month"), F.lit(last)))


def year_grid(panel: DataFrame, ctx: PlanContext) -> DataFrame:
    """The 13 months up to the plan month for clients seen in them; missing months are 0."""
    year = panel.select("segment", "month", "target").filter(
        F.col("month").between(F.lit(ctx.year_from), F.lit(ctx.plan_month))
    )
    return _zero_filled(_spread(year, F.lit(ctx.year_from), F.lit(ctx.plan_month)))
