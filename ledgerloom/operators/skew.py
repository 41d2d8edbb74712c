"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
# A key below this part of all rows is no burden among so many tasks; it also bounds the number of hot keys.
HOT_SHARE = 10_000


def hot_keys(counts: DataFrame, key: str, rows: str, min_rows: int = HOT_ROWS, share: int = HOT_SHARE) -> DataFrame:
    """Keys with at least ``min_rows`` rows and a ``share``-th part of all, with the ``_salts`` that leave
    ``min_rows`` rows to each. ``counts`` has distinct keys and their rows; at most ``share`` keys are hot."""
    total = counts.agg(F.sum(rows)).scalar()
    hot = F.col(key).isNotNull() & (F.col(rows) >= min_rows) & (F.col(rows) * share >= total)
    return counts.where(hot).select(F.col(key).alias("_hot"), F.ceil(F.col(rows) / min_rows).cast("int").alias("_salts"))


def lookup(
    left: DataFrame,
    right: DataFrame,
    counts: DataFrame,
    key: str,
    rows: str,
    spread: Column,
    min_rows: int = HOT_ROWS,
    share: int = HOT_SHARE,
) -> DataFrame:
    """Left join to a table that is unique on ``key``.

    ``counts`` has the number of left ``rows`` per key. Left rows of a hot key are spread over as many
    tasks as its rows call for, by ``spread`` (a column that varies within the key), and only the right
    rows of hot keys are repeated. The few hot keys are joined in whatever way Spark finds best.
    """
    hot = hot_keys(counts, key, rows, min_rows, share)
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")).cast("int"), F.lit(0))
    salted = left.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot", "_salts")
    all_salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = right.drop(rows).join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(all_salts))
    return salted.join(copies.drop("_hot", "_salts"), [key, "_salt"], "left").drop("_salt")
