"""Registered queries against their DuckDB SQL on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from salesloom.operators import boosting
from salesloom.operators.tuning import SearchBudget
from salesloom.plans import entire
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def plain(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "NULL"
        if isinstance(value, bool):
            return str(value)
        return repr(float(value)) if isinstance(value, (int, float)) else str(value)

    return sorted(columns), sorted(tuple(plain(row[k]) for k in order) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    relation = duck.sql(contract.oracle_sql()[name])
    assert comparable(df.columns, df.collect()) == comparable(relation.columns, relation.fetchall())


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("gbt_cluster_forecast", [boosting.absolute_family(), boosting.squared_family()]),
        ("feature_importances", [boosting.squared_family()]),
        ("parameter_search_trials", [boosting.squared_family(budget=SearchBudget(5, 25, 5))]),
        ("entire_plan_result", [boosting.absolute_family(), boosting.squared_family()]),
    ],
)
def test_boosted_queries_use_the_families_own_parameters(spark, monkeypatch, name, expected):
    class Fitted(Exception):
        pass

    def fit(active, cards, calendar, families, *_, **__):
        raise Fitted(families)

    monkeypatch.setattr(boosting, "fit_families", fit)
    monkeypatch.setattr(entire, "fit_families", fit)
    with pytest.raises(Fitted) as found:
        contract.queries()[name](spark, DATA)
    assert list(found.value.args[0]) == expected


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["segment", "sale_loc", "level", "stage", "target"]
    assert df.count() > 0
