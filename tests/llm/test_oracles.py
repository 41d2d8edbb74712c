"""The queries that SQL can express, against their SQL on the small tables."""

import duckdb
import pytest

from ledgerloom.llm import queries as q

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(q.ORACLE))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = connection.execute(q.ORACLE[name])
    columns = [c[0] for c in result.description]
    expected = sorted(result.fetchall())
    assert sorted(tuple(r) for r in q.QUERIES[name](spark, SF).select(*columns).collect()) == expected and expected
