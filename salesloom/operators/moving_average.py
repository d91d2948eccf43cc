"""Moving-average forecasts and their backtest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import SMA_WINDOWS, PlanContext, shift_months


def _sum_between(first: date, last: date) -> str:
    inside = f"month between date'{first}' and date'{last}'"
    return f"coalesce(sum(case when {inside} then target end), 0)"


def _forecast(month: date, window: int) -> str:
    """Mean of the ``window`` months before ``month``, months without a row counting 0."""
    return f"{_sum_between(shift_months(month, -window), shift_months(month, -1))} / {window}"


def fold_score(errors: Sequence[str]) -> str:
    """Mean plus sample standard deviation of the fold errors; 0 for the deviation of one."""
    n = len(errors)
    mean = f"(({' + '.join(errors)}) / {n}D)"
    if n == 1:
        return mean
    squares = " + ".join(f"({e} - {mean}) * ({e} - {mean})" for e in errors)
    return f"({mean} + sqrt(({squares}) / {n - 1}D))"


def moving_average_scores(
    panel: DataFrame, ctx: PlanContext, windows: Sequence[int] = SMA_WINDOWS
) -> DataFrame:
    """Per client and model: truncated backtest score, holdout and plan-month forecasts.

    A window over the zero-filled month grid has a fixed length, so its mean is a conditional
    sum over that length. One aggregate per client replaces the grid, the windows and the refits.
    """
    months = {0: ctx.holdout} | {k: ctx.fold_month(k) for k in range(1, ctx.folds + 1)}
    sums = [f"{_sum_between(m, m)} as actual_{k}" for k, m in months.items() if k]
    for w in windows:
        sums += [f"{_forecast(m, w)} as sma{w}_{k}" for k, m in months.items()]
        sums.append(f"{_forecast(ctx.plan_month, w)} as sma{w}_final")
    wide = panel.groupBy("segment").agg(*map(F.expr, sums))
    models = []
    for w in windows:
        errors = [f"abs(actual_{k} - sma{w}_{k})" for k in range(1, ctx.folds + 1)]
        models.append(
            f"struct('sma{w}' as model, double(bigint({fold_score(errors)})) as mae, "
            f"sma{w}_0 as hd_preds, sma{w}_final as final_preds)"
        )
    scores = wide.select("segment", F.expr(f"inline(array({', '.join(models)}))"))
    return scores.filter(~((F.col("model") == "sma1") & (F.col("hd_preds") == 0)))


def moving_average_backtest(
    panel: DataFrame, ctx: PlanContext, windows: Sequence[int] = SMA_WINDOWS
) -> DataFrame:
    """Each fold of the backtest: client, model, month, actual, forecast and absolute error."""
    sums = []
    for k in range(1, ctx.folds + 1):
        month = ctx.fold_month(k)
        sums.append(f"{_sum_between(month, month)} as actual_{k}")
        sums += [f"{_forecast(month, w)} as sma{w}_{k}" for w in windows]
    wide = panel.groupBy("segment").agg(*map(F.expr, sums))
    folds = ", ".join(
        f"struct('sma{w}' as model, date'{ctx.fold_month(k)}' as month, "
        f"actual_{k} as actual, sma{w}_{k} as forecast)"
        for w in windows
        for k in range(1, ctx.folds + 1)
    )
    return wide.select("segment", F.expr(f"inline(array({folds}))")).withColumn(
        "abs_error", F.abs(F.col("actual") - F.col("forecast"))
    )
