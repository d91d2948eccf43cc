import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from salesloom import functions as fn
from salesloom.context import PlanContext, entire_levels, own_brand_steps, shift_months
from salesloom.functions.quantiles import exact_quantiles


def test_context_dates():
    ctx = PlanContext.from_month("2023-10-01")
    assert ctx.churn_from == date(2023, 7, 1)
    assert ctx.holdout == ctx.card_period == date(2023, 9, 1)
    assert ctx.year_from == date(2022, 10, 1)
    assert ctx.history_end == date(2023, 9, 30)
    assert ctx.calendar_end == date(2023, 10, 31)
    assert ctx.fold_month(3) == date(2023, 6, 1)
    assert shift_months(date(2023, 1, 1), -1) == date(2022, 12, 1)
    with pytest.raises(ValueError):
        PlanContext.from_month("2023-10-15")


def test_retry_levels():
    levels = entire_levels()
    assert [v.level for v in levels] == list(range(7))
    assert (levels[0].to_15, levels[0].band_step, levels[0].big_gap) == (0.2, 0.05, 0.15)
    assert levels[6].very_low == pytest.approx(1.22)
    assert levels[6].band_step == pytest.approx(0.22)
    assert levels[6].to_5 == 0.1 and levels[6].to_25 == 0.25
    assert own_brand_steps() == pytest.approx([0.015, 0.04, 0.06, 0.08, 0.1, 0.12, 0.14])


def test_column_helpers(spark):
    row = spark.range(1).select(
        fn.whole(F.lit(1.7)).alias("cut"),
        fn.whole(F.lit(-1.7)).alias("cut_negative"),
        fn.ratio(F.lit(1), F.lit(0)).alias("no_ratio"),
        fn.clean_manager(F.lit("Ivanov (12), A1")).alias("manager"),
        fn.absolute_percentage_error(F.lit(10.0), F.lit(8.0)).alias("ape"),
        fn.blended_error(F.lit(10.0), F.lit(20.0)).alias("error"),
        fn.non_negative(F.lit(-3.0)).alias("clipped"),
        *[fn.season_number(F.lit(date(2023, m, 1))).alias(f"m{m}") for m in range(1, 13)],
    ).first()
    assert (row["cut"], row["cut_negative"], row["no_ratio"]) == (1, -1, None)
    assert row["manager"] == "ivanov  a"
    assert row["ape"] == pytest.approx(0.2)
    assert row["error"] == pytest.approx(0.33 * 10 + 0.66 * 20)
    assert row["clipped"] == 0.0
    assert [row[f"m{m}"] for m in range(1, 13)] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]


@pytest.mark.parametrize("kind", ["spread", "heavy_tie", "constant"])
def test_exact_quantiles_by_brackets(spark, kind):
    rng = random.Random(1)
    values = [rng.lognormvariate(5, 2) for _ in range(5000)]
    if kind == "heavy_tie":
        values[:2000] = [100.0] * 2000
    if kind == "constant":
        values = [3.0] * 500
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    found = exact_quantiles(df, "x", probabilities)
    direct = df.agg(F.percentile("x", F.array(*map(F.lit, probabilities)))).first()[0]
    assert found == pytest.approx(direct, rel=1e-12)


def test_rounded_equals_round(spark):
    rng = random.Random(6)
    values = [k / 20_000 for k in range(-400, 400)] + [1.00005, 2.00015, 1234.56785, 0.00005, 1e-300, 1e11, 123456789012345.67891]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 16) for _ in range(3000)] + [round(rng.uniform(0, 1e6), 5) for _ in range(2000)]
    values += [float("nan"), float("inf"), float("-inf"), None, 0.0, -0.0]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 2, 4):
        differ = rows.filter(~fn.rounded(F.col("x"), digits).eqNullSafe(F.round("x", digits)))
        assert differ.collect() == []
