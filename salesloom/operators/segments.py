"""Client classes by activity, and the forecasts that follow from the class alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.context import PlanContext
from salesloom.operators.panel import by_client


def _label(recent_sum: Column, recent_max: Column, months: Column, ctx: PlanContext, low: float) -> Column:
    return (
        F.when(F.coalesce(recent_sum, F.lit(0)) == 0, F.lit("churned"))
        .when(recent_max <= F.lit(low), F.lit("low"))
        .when(months < ctx.rare_months, F.lit("rare"))
        .otherwise(F.lit("active"))
    )


def _recent(ctx: PlanContext) -> Column:
    return F.when(F.col("month") >= F.lit(ctx.churn_from), F.col("target"))


def segment_classes(panel: DataFrame, ctx: PlanContext, low: float) -> DataFrame:
    """One row per client: churned, low, rare or active, tested in this order.

    Months are counted before gap filling.
    """
    recent = _recent(ctx)
    facts = panel.groupBy("segment").agg(
        F.sum(recent).alias("recent_sum"),
        F.max(recent).alias("recent_max"),
        F.count("month").alias("months"),
    )
    label = _label(F.col("recent_sum"), F.col("recent_max"), F.col("months"), ctx, low)
    return facts.select("segment", label.alias("segment_class"))


def with_segment_class(panel: DataFrame, ctx: PlanContext, low: float) -> DataFrame:
    """The same label on every panel row, by a window, so the panel is shuffled once only."""
    recent = _recent(ctx)
    label = _label(
        F.sum(recent).over(by_client()),
        F.max(recent).over(by_client()),
        F.count("month").over(by_client()),
        ctx,
        low,
    )
    return panel.withColumn("segment_class", label)


def class_forecasts(classed: DataFrame, ctx: PlanContext, low: float) -> DataFrame:
    """Forecasts of clients outside the models, from the labelled panel.

    Rare clients get their mean of the months since the churn date, at least the threshold;
    low ones the threshold, churned ones zero.
    """
    return (
        classed.filter("segment_class <> 'active'")
        .groupBy("segment", "segment_class")
        .agg(F.avg(_recent(ctx)).alias("recent_mean"))
        .select(
            "segment",
            F.when(F.col("segment_class") == "rare", F.greatest("recent_mean", F.lit(low)))
            .when(F.col("segment_class") == "low", F.lit(low))
            .otherwise(F.lit(0.0))
            .alias("target"),
        )
    )
