"""Exact linear-interpolated quantiles: of one row's array, and of a whole column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# relative rank error of the sketch that brackets the wanted ranks
SKETCH_ACCURACY = 20_000


def padded_sorted(values: Column, size: int) -> Column:
    """Sorted array of exactly ``size`` numbers, missing ones counting as zero."""
    missing = F.greatest(F.lit(size) - F.size(values), F.lit(0))
    return F.sort_array(F.concat(values, F.array_repeat(F.lit(0.0), missing)))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Exact quantiles of a column of any size, as driver numbers (one per probability).

    A sketch gives a narrow value bracket around each wanted rank, one pass counts what lies
    below, and only the distinct values inside the brackets are ordered. No task ever holds
    the column. ``df`` is read four times, so pass a staged table.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    bounds = values.agg(F.count("v").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).first()
    n = bounds["n"]
    if n == 0:
        return [math.nan for _ in probabilities]

    low_rank = [math.floor(p * (n - 1)) for p in probabilities]
    high_rank = [min(r + 1, n - 1) for r in low_rank]
    slack = 2 * n // SKETCH_ACCURACY + 2
    while True:
        shares = [max(0.0, (r - slack) / n) for r in low_rank]
        shares += [min(1.0, (r + 1 + slack) / n) for r in high_rank]
        sketch = values.agg(
            F.percentile_approx("v", F.array(*map(F.lit, shares)), SKETCH_ACCURACY)
        ).first()[0]
        k = len(probabilities)
        # a bracket that reaches an end of the column takes the true end
        left = [bounds["a"] if shares[i] == 0.0 else sketch[i] for i in range(k)]
        right = [bounds["b"] if shares[k + i] == 1.0 else sketch[k + i] for i in range(k)]
        counts = values.agg(
            *[F.count_if(F.col("v") < left[i]).alias(f"below_{i}") for i in range(k)],
            *[F.count_if(F.col("v") <= right[i]).alias(f"upto_{i}") for i in range(k)],
        ).first()
        below = [counts[f"below_{i}"] for i in range(k)]
        if all(below[i] <= low_rank[i] and counts[f"upto_{i}"] > high_rank[i] for i in range(k)):
            break
        slack *= 4

    hits = F.array_compact(
        F.array(*[F.when(F.col("v").between(left[i], right[i]), F.lit(i)) for i in range(k)])
    )
    distinct = (
        values.select("v", F.explode(hits).alias("i")).groupBy("i", "v").agg(F.count("*").alias("c"))
    )
    upto = F.sum("c").over(Window.partitionBy("i").orderBy("v"))
    ranked = distinct.withColumn("upto", upto + F.get(F.array(*map(F.lit, below)), F.col("i")))
    wanted_low = F.get(F.array(*map(F.lit, low_rank)), F.col("i"))
    wanted_high = F.get(F.array(*map(F.lit, high_rank)), F.col("i"))
    rows = ranked.groupBy("i").agg(
        F.min(F.when(F.col("upto") > wanted_low, F.col("v"))).alias("lo"),
        F.min(F.when(F.col("upto") > wanted_high, F.col("v"))).alias("hi"),
    )
    found = {row["i"]: (row["lo"], row["hi"]) for row in rows.collect()}
    return [
        found[i][0] + (found[i][1] - found[i][0]) * (p * (n - 1) - low_rank[i])
        for i, p in enumerate(probabilities)
    ]
