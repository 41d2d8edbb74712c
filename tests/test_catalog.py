"""Every registered query against its SQL on the small tables."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry_points
from ledgerloom.catalog import registry

SF = "/root/testdata/sf0.01"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value.isoformat() if isinstance(value, datetime) else value


def ordered(columns, rows):
    keep = sorted(columns)
    return keep, sorted((tuple(plain(row[columns.index(c)]) for c in keep) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) > 60
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    result = oracle.execute(ORACLE[name])
    expected = ordered([c[0] for c in result.description], result.fetchall())
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == expected
    assert expected[1], "an empty result proves nothing"


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["label", "n", "share_of_max"] and df.count() > 0
