"""Column helpers shared by the operators; all of them are built-in expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def whole(value: Column) -> Column:
    """Integer part, cut toward zero."""
    return value.cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def non_negative(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def rounded(value: Column, digits: int) -> Column:
    """``F.round`` of a double, by plain arithmetic but for what lies close to the middle of two results, or is very large."""
    scale = F.lit(float(10**digits))
    steps = value * scale
    nearest = F.rint(steps)
    sure = (F.abs(steps) < F.lit(1e11)) & (F.abs(steps - nearest) < F.lit(0.499))
    return F.when(sure, nearest / scale).otherwise(F.round(value, digits))


def absolute_percentage_error(actual: Column, forecast: Column) -> Column:
    floor = F.lit(sys.float_info.epsilon)
    return F.abs(actual - forecast) / F.greatest(F.abs(actual), floor)


def blended_error(backtest: Column, holdout: Column) -> Column:
    return backtest * F.lit(0.33) + holdout * F.lit(0.66)


def clean_manager(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[0-9,()]+", ""))


def season_number(month: Column) -> Column:
    """1 winter (December to February), 2 spring, 3 summer, 4 autumn."""
    return (F.floor((F.month(month) % 12) / 3) + 1).cast("int")
