"""Plan-run inputs derived from the TPC-H-like test tables.

Plan month 2001-08-01. Each function maps given tables onto one input schema, so every query
built on them grows with the tables.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.context import COMMERCE_ACTIVITY, PlanContext
from salesloom.operators.month_calendar import day_spine

FIXTURE_CONTEXT = PlanContext(plan_month=date(2001, 8, 1), history_start=date(1995, 1, 1))
FIXED_HOLIDAYS = (
    *[f"01-{d:02d}" for d in range(1, 9)],
    "02-23",
    "03-08",
    "05-01",
    "05-09",
    "06-12",
    "11-04",
)
RECODE = [("NATION_22", "NATION_0"), ("NATION_23", "NATION_1"), ("NATION_24", "NATION_2")]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = f"{root}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def shipments(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag"
    )
    orders = table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    parts = table(spark, root, "part").select("p_partkey", "p_size", "p_retailprice")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("site_use_id"),
            F.col("o_orderdate").cast("date").alias("ordered_day"),
            F.col("l_extendedprice").alias("cost_rub"),
            F.col("l_quantity").alias("volume"),
            F.col("p_size").cast("double").alias("weight"),
            F.col("p_retailprice").alias("med_amn"),
            F.col("l_tax").alias("nds_rate"),
            (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("web_order_flag"),
            (F.col("l_returnflag") == "R").cast("int").alias("dlo_id"),
            F.col("l_partkey").alias("cd_m"),
            F.when(F.col("o_orderstatus") != "P", 1).otherwise(2).alias("oper_tp_id"),
        )
    )


def products(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        F.col("p_partkey").alias("medicine_code"), (F.col("p_type") == "PROMO").cast("int").alias("own_mark")
    )


def _customers(spark: SparkSession, root: str) -> DataFrame:
    nation = table(spark, root, "nation")
    return table(spark, root, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def _each(n: int, rest: int = 0) -> Column:
    return F.col("c_custkey") % n == rest


def plan_links(spark: SparkSession, root: str) -> DataFrame:
    periods = F.array(F.lit(date(2001, 6, 1)), F.lit(date(2001, 7, 1)))
    return _customers(spark, root).select(
        F.col("c_custkey").alias("site_id_link"),
        F.col("c_custkey").alias("customers"),
        F.floor("c_acctbal").cast("bigint").alias("value"),
        F.explode(periods).alias("plan_period"),
        F.col("c_name").alias("customer_name"),
        F.when(~_each(11), F.col("n_name")).alias("current_sale_loc"),
    )


def customers(spark: SparkSession, root: str) -> DataFrame:
    """Billing rows; every tenth customer has a second one with three times the turnover."""
    turnover = (
        F.when(_each(13), F.lit(None).cast("double"))
        .when(_each(17), F.lit(0.0))
        .when(_each(19), F.lit(1.0))
        .otherwise(F.lit(100000.0) + F.abs("c_acctbal") * 500)
    )
    multiples = F.when(_each(10), F.array(F.lit(1.0), F.lit(3.0))).otherwise(F.array(F.lit(1.0)))
    return (
        table(spark, root, "customer")
        .withColumn("_multiple", F.explode(multiples))
        .select(
            F.col("c_custkey").alias("customers"),
            (turnover * F.col("_multiple")).alias("turnover"),
            F.when(_each(20, 19), "I").otherwise("A").alias("bill_status"),
        )
    )


def partners(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("c_custkey")
    yes_no = lambda condition: F.when(condition, "Y").otherwise("N")
    return table(spark, root, "customer").select(
        key.alias("site_use_id"),
        key.alias("segment"),
        F.concat("c_mktsegment", F.lit(" ("), (key % 7).cast("string"), F.lit(")")).alias("manager"),
        F.col("c_mktsegment").alias("subsegment_tp"),
        (key % 3).cast("int").alias("ltk"),
        F.when(~_each(8), (key % 4) * 7).cast("int").alias("claim_period"),
        (key % 5).cast("int").alias("period_shipment"),
        (key % 6).cast("int").alias("current_discount_2k"),
        yes_no(_each(50)).alias("service_flag"),
        yes_no(_each(4)).alias("regional_capital"),
        yes_no(_each(6, 1)).alias("strong_med"),
        F.when(_each(200), "RARE").otherwise(F.concat(F.lit("L"), (key % 3).cast("string"))).alias("license_tp"),
        yes_no(_each(9)).alias("federal"),
        F.when(~_each(5), yes_no(_each(2))).alias("inet_flag"),
        F.when(_each(25, 24), "I").otherwise("A").alias("site_status"),
        F.when(_each(40, 38), "Other").otherwise(COMMERCE_ACTIVITY).alias("activity"),
    )


def site_branch(spark: SparkSession, root: str) -> DataFrame:
    """Three dated rows per client; the newest may lack the branch."""
    rows = F.array(
        F.struct(F.lit("NATION_0").alias("sale_loc"), F.lit(date(2000, 1, 1)).alias("updated")),
        F.struct(F.col("n_name").alias("sale_loc"), F.lit(date(2001, 1, 1)).alias("updated")),
        F.struct(
            F.when(~_each(7), F.col("n_name")).alias("sale_loc"), F.lit(date(2001, 6, 1)).alias("updated")
        ),
    )
    return _customers(spark, root).select(F.col("c_custkey").alias("segment"), F.inline(rows))


def branch_plans(spark: SparkSession, root: str) -> DataFrame:
    """Monthly average of a branch's last year times 0.60 to 1.95; one branch has no plan."""
    lines = shipments(spark, root).filter(
        F.col("ordered_day").between(F.lit(date(2000, 8, 1)), F.lit(date(2001, 7, 31)))
        & (F.col("oper_tp_id") == 1)
    )
    own = products(spark, root).filter("own_mark = 1").select(F.col("medicine_code").alias("cd_m"), "own_mark")
    cost = F.col("cost_rub").cast("decimal(18,2)")
    per_client = (
        lines.join(own, "cd_m", "left")
        .groupBy("site_use_id")
        .agg(
            F.sum(cost).alias("all_cost"),
            F.coalesce(F.sum(F.when(F.col("own_mark") == 1, cost)), F.lit(0)).alias("own_cost"),
        )
    )
    monthly = lambda name, shift: F.floor(
        F.sum(name).cast("double") / 12 * (F.lit(0.6) + F.lit(0.15) * ((F.col("n_nationkey") + shift) % 10))
    ).cast("double")
    months = F.array(F.lit(date(2001, 7, 1)), F.lit(date(2001, 8, 1)))
    return (
        per_client.join(_customers(spark, root), F.col("site_use_id") == F.col("c_custkey"))
        .filter("n_nationkey <> 7")
        .groupBy("n_name", "n_nationkey")
        .agg(
            monthly("all_cost", 0).alias("plan_value"),
            monthly("own_cost", 3).alias("plan_value_stm"),
            monthly("own_cost", 5).alias("plan_value_oz"),
            monthly("own_cost", 7).alias("plan_value_onls"),
        )
        .select(
            F.col("n_name").alias("sale_loc"),
            F.explode(months).alias("plan_month"),
            "plan_value",
            "plan_value_stm",
            "plan_value_oz",
            "plan_value_onls",
        )
    )


def calendar(spark: SparkSession, ctx: PlanContext = FIXTURE_CONTEXT) -> DataFrame:
    day = F.col("day")
    holiday = F.date_format(day, "MM-dd").isin(*FIXED_HOLIDAYS)
    working = ~holiday & F.weekday(day).between(0, 4)
    return day_spine(spark, ctx).select(
        "day", holiday.cast("int").alias("is_holiday"), working.cast("int").alias("is_working_day")
    )


class FixtureSources:
    """The tables of :class:`Sources`, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root

    @cached_property
    def shipments(self) -> DataFrame:
        return shipments(self._spark, self._root)

    @cached_property
    def products(self) -> DataFrame:
        return products(self._spark, self._root)

    @cached_property
    def plan_links(self) -> DataFrame:
        return plan_links(self._spark, self._root)

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self._spark, self._root)

    @cached_property
    def partners(self) -> DataFrame:
        return partners(self._spark, self._root)

    @cached_property
    def site_branch(self) -> DataFrame:
        return site_branch(self._spark, self._root)

    @cached_property
    def branch_plans(self) -> DataFrame:
        return branch_plans(self._spark, self._root)

    @cached_property
    def branch_recode(self) -> DataFrame:
        return self._spark.createDataFrame(RECODE, "old string, new string")

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar(self._spark)


def fixture_sources(spark: SparkSession, root: str) -> FixtureSources:
    return FixtureSources(spark, root)
