"""Day spine and monthly holiday and working-day counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import PlanContext
from salesloom.functions import month_start


def day_spine(spark: SparkSession, ctx: PlanContext) -> DataFrame:
    days = F.sequence(F.lit(ctx.history_start), F.lit(ctx.calendar_end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("day"))


def month_days(calendar: DataFrame, ctx: PlanContext) -> DataFrame:
    """Holidays and working days of each month in range; a day without a mark counts 0."""
    spine = day_spine(calendar.sparkSession, ctx)
    return (
        spine.join(calendar, "day", "left")
        .groupBy(month_start(F.col("day")).alias("month"))
        .agg(
            F.sum(F.coalesce("is_holiday", F.lit(0))).alias("holidays"),
            F.sum(F.coalesce("is_working_day", F.lit(0))).alias("work_day"),
        )
    )


def with_month_days(panel: DataFrame, calendar: DataFrame, ctx: PlanContext) -> DataFrame:
    # one row per month of the history range, so the broadcast is bounded by construction
    return panel.join(F.broadcast(month_days(calendar, ctx)), "month")
