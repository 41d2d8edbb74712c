"""Access to the given tables, and small helpers shared by the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; wall-clock timestamps become UTC instants at the source."""
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    for field, kind in df.dtypes:
        if kind == "timestamp_ntz":
            df = df.withColumn(field, F.col(field).cast("timestamp"))
    return df


def text_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def utc(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# SQL spelling of the same Unicode white space and word boundaries for the comparison engine.
SQL_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
SQL_STRIP = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)"
    "||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)"
    "||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)
SQL_LEFT = r"(^|[^\p{L}\p{M}\p{N}_])"
SQL_RIGHT = r"($|[^\p{L}\p{M}\p{N}_])"


def sql_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_chunk(source: str, budget: int) -> str:
    """Rows of a table with a ``text`` column, its stripped form ``whole`` and its ``chunk``."""
    return f"""
      SELECT *, CASE WHEN length(whole) <= {budget} THEN whole
        WHEN para > {budget} * 0.5 THEN trim(left(win, para), {SQL_STRIP})
        WHEN sent > {budget} * 0.5 THEN trim(left(win, sent), {SQL_STRIP})
        ELSE trim(win, {SQL_STRIP}) END AS chunk
      FROM (SELECT *, length(regexp_extract(win, '(?s)^(.*)\\n\\n', 1)) AS para,
              length(regexp_extract(win, '(?s)^(.*[.!?]{SQL_SPACE})', 1)) AS sent
            FROM (SELECT *, left(whole, {budget}) AS win
                  FROM (SELECT *, trim(coalesce(text, ''), {SQL_STRIP}) AS whole FROM {source})))"""


def sql_bars(labels: str) -> str:
    return f"""WITH c AS (SELECT label, count(*) AS n FROM ({labels}) GROUP BY label)
      SELECT label, n, CAST(round(n * 100.0 / (SELECT max(n) FROM c), 0) AS INTEGER) AS share_of_max FROM c"""
