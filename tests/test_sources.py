from datetime import date

import pytest

from salesloom.context import BRANCH_RECODE, PlanContext
from salesloom.operators.wallet import default_recode
from salesloom.sources.loaders import branch_plans_for
from salesloom.sources.tables import SCHEMAS, Sources, conform, read_plan_month, read_table, write_result


def test_missing_column_is_reported(spark):
    with pytest.raises(ValueError, match="own_mark"):
        conform(spark.createDataFrame([(1,)], "medicine_code bigint"), "products")


def test_types_are_cast_and_further_columns_kept(spark):
    df = conform(spark.createDataFrame([("7", 1, "x")], "medicine_code string, own_mark bigint, note string"), "products")
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "int", "string"]
    assert tuple(df.first()) == (7, 1, "x")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_round_trip(spark, tmp_path, fmt):
    rows = [("A", date(2023, 10, 1), 1.5, 2.5, 3.5, None)]
    path = str(tmp_path / "plans")
    write_result(spark.createDataFrame(rows, SCHEMAS["branch_plans"]), path, fmt)
    assert [tuple(r) for r in read_table(spark, path, "branch_plans", fmt).collect()] == rows


def test_all_tables_are_read_from_one_folder(spark, tmp_path):
    for name, schema in SCHEMAS.items():
        write_result(spark.createDataFrame([], schema), str(tmp_path / name), "parquet")
    sources = Sources.read(spark, str(tmp_path))
    assert sources.calendar.columns == SCHEMAS["calendar"].names


def test_given_table_is_not_read(spark, tmp_path):
    for name in SCHEMAS.keys() - {"branch_recode"}:
        write_result(spark.createDataFrame([], SCHEMAS[name]), str(tmp_path / name), "parquet")
    sources = Sources.read(spark, str(tmp_path), branch_recode=default_recode(spark))
    assert {tuple(r) for r in sources.branch_recode.collect()} == set(BRANCH_RECODE.items())


def test_plan_month_file(spark, tmp_path):
    path = tmp_path / "month.csv"
    path.write_text("plan_month_fact,other\n2023-10-01,x\n")
    assert read_plan_month(spark, str(path)) == date(2023, 10, 1)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "products")
    given = spark.createDataFrame([(1, 7, "x")], "own_mark int, medicine_code long, note string")
    given.write.option("header", "true").csv(path)
    row = read_table(spark, path, "products", "csv").first()
    assert (row["medicine_code"], row["own_mark"], row["note"]) == (7, 1, "x")
    bare = str(tmp_path / "bare")
    given.select("medicine_code", "own_mark").write.csv(bare)
    assert tuple(read_table(spark, bare, "products", "csv", header="false").first()) == (7, 1)


def test_repeated_branch_plan_counts_once(spark):
    rows = [("A", date(2023, 10, 1), 1.0, 2.0, 3.0, None), ("A", date(2023, 10, 1), 4.0, 1.0, 3.0, None)]
    plans = spark.createDataFrame(rows, SCHEMAS["branch_plans"])
    ctx = PlanContext.from_month("2023-10-01")
    assert [tuple(r)[2] for r in branch_plans_for(plans, "entire", ctx).collect()] == [4.0]
    assert [tuple(r)[2] for r in branch_plans_for(plans, "own_brand", ctx).collect()] == [2.0]
