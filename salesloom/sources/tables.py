"""Input schemas, readers and the result sink."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


def _schema(text: str) -> T.StructType:
    """Schema from ``name type`` pairs, without needing a session."""
    pairs = (pair.split() for pair in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "shipments": _schema(
        "site_use_id bigint, ordered_day date, cost_rub double, volume double, weight double, "
        "med_amn double, nds_rate double, web_order_flag int, dlo_id int, cd_m bigint, oper_tp_id int"
    ),
    "products": _schema("medicine_code bigint, own_mark int"),
    "plan_links": _schema(
        "site_id_link bigint, customers bigint, value bigint, plan_period date, "
        "customer_name string, current_sale_loc string"
    ),
    "customers": _schema("customers bigint, turnover double, bill_status string"),
    "partners": _schema(
        "site_use_id bigint, segment bigint, manager string, subsegment_tp string, ltk int, "
        "claim_period int, period_shipment int, current_discount_2k int, service_flag string, "
        "regional_capital string, strong_med string, license_tp string, federal string, "
        "inet_flag string, site_status string, activity string"
    ),
    "site_branch": _schema("segment bigint, sale_loc string, updated date"),
    "branch_plans": _schema(
        "sale_loc string, plan_month date, plan_value double, plan_value_stm double, "
        "plan_value_oz double, plan_value_onls double"
    ),
    "branch_recode": _schema("old string, new string"),
    "calendar": _schema("day date, is_holiday int, is_working_day int"),
}


@dataclass(frozen=True)
class Sources:
    """The input tables of a plan run."""

    shipments: DataFrame
    products: DataFrame
    plan_links: DataFrame
    customers: DataFrame
    partners: DataFrame
    site_branch: DataFrame
    branch_plans: DataFrame
    branch_recode: DataFrame
    calendar: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, root: str, fmt: str = "parquet", **given: DataFrame) -> Sources:
        """One table per schema below ``root``; tables given by name are not read."""
        named = {name: conform(df, name) for name, df in given.items()}
        for name in SCHEMAS.keys() - named.keys():
            named[name] = read_table(spark, f"{root}/{name}", name, fmt)
        return cls(**named)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Check a table against its schema and cast its columns; further columns are kept."""
    wanted = SCHEMAS[name]
    present = {field.name: field.dataType for field in df.schema}
    missing = [field.name for field in wanted if field.name not in present]
    if missing:
        raise ValueError(f"table {name} lacks columns {missing}")
    casts = {
        field.name: F.col(field.name).cast(field.dataType)
        for field in wanted
        if present[field.name] != field.dataType
    }
    return df.withColumns(casts) if casts else df


def read_table(
    spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Read one input table.

    Columns are found by name, whatever their order: a CSV's header gives the names and all values
    come as strings, which are then cast. A CSV without a header (option header=false) has the
    schema's columns in the schema's order. JSON takes the schema; columnar formats and JDBC bring
    their own, which is checked. JDBC connection options, credentials among them, come from the caller.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv" and str(options.get("header", "true")).lower() == "true":
        reader = reader.option("header", "true")
    elif fmt in ("csv", "json"):
        reader = reader.schema(SCHEMAS[name])
    return conform(reader.load() if fmt == "jdbc" else reader.load(path), name)


def read_plan_month(spark: SparkSession, path: str) -> date:
    """Plan month from a one-row CSV; only that column is read."""
    row = spark.read.option("header", "true").csv(path).select("plan_month_fact").first()
    if row is None:
        raise ValueError(f"{path} holds no plan month")
    return date.fromisoformat(row[0][:10])


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
