"""Window features of the monthly panel, all over one client-by-month window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.context import EXOGENOUS, PlanContext
from salesloom.functions import ratio, season_number
from salesloom.operators.panel import by_month, extend_to

TARGET_LAGS = (1, 3, 6)


def with_future_rows(panel: DataFrame, ctx: PlanContext) -> DataFrame:
    """Extend each client with NULL rows up to the plan month, the row to be forecast."""
    return extend_to(panel, ctx.plan_month)


def lag_features(exogenous: tuple[str, ...] = EXOGENOUS, horizon: int = 1) -> dict[str, Column]:
    lags = {f"lag_{k}": F.lag("target", k).over(by_month()) for k in TARGET_LAGS}
    lags |= {f"lag_{c}_{horizon}": F.lag(c, horizon).over(by_month()) for c in exogenous}
    return lags


def _frame(window: int, shift: int):
    return by_month().rowsBetween(-(window - 1) - shift, -shift)


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def rolling_features(shift: int = 1, wide_window: int = 12) -> dict[str, Column]:
    """Trailing statistics over the present months of a frame; none present gives 0.

    ``shift=0`` lets the frame end on the row's own month, ``shift=1`` on the month before,
    which keeps a row's target out of its own features.
    """
    target = F.col("target").cast("double")
    found = {}
    for window in (3, 6):
        frame = _frame(window, shift)
        found[f"mean_{window}"] = _or_zero(F.avg(target).over(frame))
        found[f"std_{window}"] = _or_zero(F.stddev_samp(target).over(frame))
        found[f"min_{window}"] = _or_zero(F.min(target).over(frame))
        found[f"max_{window}"] = _or_zero(F.max(target).over(frame))
        found[f"minmax_{window}"] = found[f"max_{window}"] - found[f"min_{window}"]
    wide = _frame(wide_window, shift)
    found["minmax_12"] = _or_zero(F.max(target).over(wide) - F.min(target).over(wide))
    return found


def _back(k: int) -> Column:
    return (F.lag("target", k).over(by_month()) if k else F.col("target")).cast("double")


def _mean_of(values: list[Column]) -> Column:
    present = reduce(Column.__add__, [v.isNotNull().cast("int") for v in values])
    total = reduce(Column.__add__, [_or_zero(v) for v in values])
    return ratio(total, present)


def seasonal_means(shift: int = 1) -> dict[str, Column]:
    """Means of strided months: two values three apart, three values two apart."""
    return {
        "mean_23": _or_zero(_mean_of([_back(shift + j * 3) for j in range(2)])),
        "mean_32": _or_zero(_mean_of([_back(shift + j * 2) for j in range(3)])),
    }


def mad_feature(window: int = 3, shift: int = 1) -> dict[str, Column]:
    """Mean absolute deviation from the mean of the present months of the frame."""
    values = [_back(shift + j) for j in range(window)]
    mean = _mean_of(values)
    return {f"mad_{window}": _or_zero(_mean_of([F.abs(v - mean) for v in values]))}


def date_flags() -> dict[str, Column]:
    month = F.col("month")
    return {
        "month_number": F.month(month),
        "season_number": season_number(month),
        "year_number": F.year(month),
    }


def ratio_features(panel: DataFrame) -> DataFrame:
    """Ratios of the trailing statistics; drops the minima and maxima they come from."""
    found: dict[str, Column] = {}
    for w in (3, 6):
        col = lambda name: F.col(f"{name}_{w}")
        found[f"minmax_mean_rel_{w}"] = ratio(col("minmax"), col("mean"))
        found[f"minmax_rel_{w}"] = ratio(col("min"), col("max"))
        found[f"min_rel_{w}"] = ratio(col("min"), col("mean"))
        found[f"max_rel_{w}"] = ratio(col("max"), col("mean"))
        found[f"minmax_mean_rel_{w}_flag"] = F.coalesce(
            ratio(col("minmax"), col("mean")) > 1, F.lit(False)
        ).cast("int")
    return panel.withColumns(found).drop("min_3", "max_3", "min_6", "max_6")


def window_features(panel: DataFrame, ctx: PlanContext, shift: int = 1) -> DataFrame:
    """The full set for history and plan-month rows of a gap-filled panel."""
    columns = (
        lag_features(horizon=ctx.horizon)
        | rolling_features(shift)
        | seasonal_means(shift)
        | mad_feature(shift=shift)
        | date_flags()
    )
    return ratio_features(with_future_rows(panel, ctx).withColumns(columns))


def since_first_month(panel: DataFrame, first_months: DataFrame) -> DataFrame:
    """Rows from a client's first shipment month on."""
    return panel.join(first_months, "segment", "left").filter("month >= first_month").drop("first_month")


def first_months(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("segment").agg(F.min("month").alias("first_month"))


def running_category_mean(panel: DataFrame, category: str, name: str) -> DataFrame:
    """Mean target of a category over strictly earlier months, on each panel row.

    Stands in for a category of unbounded size: no label table on the driver, and no row sees
    its own or a later month. Sums are taken per (category, month) before anything is ordered.
    """
    monthly = panel.groupBy(category, "month").agg(
        F.sum(F.col("target").cast("double")).alias("_s"), F.count("target").alias("_n")
    )
    earlier = Window.partitionBy(category).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    means = monthly.select(
        category,
        "month",
        ratio(F.sum("_s").over(earlier), F.sum("_n").over(earlier)).alias(name),
    )
    return panel.join(means, [category, "month"], "left")


def running_client_mean() -> Column:
    earlier = by_month().rowsBetween(Window.unboundedPreceding, -1)
    return F.avg(F.col("target").cast("double")).over(earlier)
