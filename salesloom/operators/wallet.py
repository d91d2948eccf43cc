"""Share-of-wallet preparation of the client forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import BRANCH_RECODE, FIXED_LOW_TARGET, TURNOVER_MULTIPLE
from salesloom.functions import ratio


def default_recode(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BRANCH_RECODE.items()), "old string, new string")


def recode_branches(df: DataFrame, recode: DataFrame) -> DataFrame:
    mapping = recode.groupBy(F.col("old").alias("sale_loc")).agg(F.max("new").alias("_new"))
    return (
        df.join(mapping, "sale_loc", "left")
        .withColumn("sale_loc", F.coalesce("_new", "sale_loc"))
        .drop("_new")
    )


def wallet_share(
    forecast: DataFrame, cards: DataFrame, branches: DataFrame, recode: DataFrame
) -> DataFrame:
    """Attach turnover (``soz``), branch and share of wallet (``fact_soz``) to each forecast.

    A missing or placeholder turnover, or one below the forecast, becomes a multiple of the
    forecast. Forecasts up to the low threshold are set to it and fill their wallet.
    """
    card = cards.select(F.col("site_id_link").alias("segment"), "turnover", "current_sale_loc")
    t = F.col("target")
    multiple = t * F.lit(TURNOVER_MULTIPLE)
    joined = (
        forecast.select("segment", F.col("target").cast("double").alias("target"))
        .join(card, "segment", "left")
        .join(branches.withColumnRenamed("sale_loc", "_known"), "segment", "left")
        .withColumn("sale_loc", F.coalesce("current_sale_loc", "_known"))
    )
    placeholder = F.col("turnover").isNull() | F.col("turnover").isin(0.0, 1.0)
    sized = joined.withColumn("soz", F.when(placeholder, multiple).otherwise(F.col("turnover")))
    sized = sized.withColumn(
        "soz", F.when(ratio(t, F.col("soz")) > 1, multiple).otherwise(F.col("soz"))
    ).withColumn("fact_soz", ratio(t, F.col("soz")))
    small = t.between(1.0, FIXED_LOW_TARGET)
    none = t == 0.0
    prepared = sized.select(
        "segment",
        F.when(small, F.lit(FIXED_LOW_TARGET)).otherwise(t).alias("target"),
        F.when(small, F.lit(FIXED_LOW_TARGET)).when(none, F.lit(0.0)).otherwise(F.col("soz")).alias("soz"),
        "sale_loc",
        F.when(small | none, F.lit(1.0)).otherwise(F.col("fact_soz")).alias("fact_soz"),
    )
    return recode_branches(prepared, recode).select("segment", "target", "soz", "sale_loc", "fact_soz")
