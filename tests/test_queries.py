from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import SF
from keyedlog.queries import ORACLE as SQL
from keyedlog.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "orders", "lineitem", "events"):
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return round(value, 6) if isinstance(value, float) else value


def bag(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(plain(t[i]) for i in order) for t in tuples)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    answer = duck.execute(SQL[name])
    expected = bag([d[0] for d in answer.description], answer.fetchall())
    assert bag(found.columns, [tuple(r) for r in found.collect()]) == expected


def test_entry(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["driver", "fare", "ts"] and found.count() == 15
