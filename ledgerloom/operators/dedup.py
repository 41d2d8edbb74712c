"""First and latest rows per key, and the exclusion of keys seen before.

``row_number() = 1`` makes Spark keep one row per key in every input task before the shuffle, so a
key that holds a third of all rows sends one row per task, not all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], *seq: str) -> DataFrame:
    """The earliest row per key in landing order; later copies in the batch are dropped."""
    return _pick(df, keys, [F.col(c).asc() for c in seq])


def latest_per_key(df: DataFrame, keys: Sequence[str], *seq: str) -> DataFrame:
    """The last written row per key."""
    return _pick(df, keys, [F.col(c).desc() for c in seq])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows where a required text is null or empty."""
    for name in columns:
        df = df.where(F.coalesce(F.col(name), F.lit("")) != "")
    return df


def exclude_seen(new: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key was not seen before.

    Call it after ``first_per_key`` on the same key: the join then reuses that partitioning,
    and only the narrow key column of the seen table is shuffled.
    """
    return new.join(seen.select(key), key, "left_anti")


def exclude_seen_small_batch(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """The same for a batch far smaller than the seen table, such as a micro-batch.

    The seen table is first reduced to the batch's own keys. Spark broadcasts the batch keys for
    that when their measured size allows it, and otherwise filters the seen side by a Bloom filter
    of them, so the large side need not be shuffled for each batch.
    """
    hits = seen.select(key).join(batch.select(key), key, "left_semi").distinct()
    return batch.join(hits, key, "left_anti")


def new_seen_keys(df: DataFrame, seen: DataFrame, key: str, record_type: str, at: Column) -> DataFrame:
    """Rows to append to the seen table; the first writer of a key stays."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return exclude_seen(keys, seen, key).select(
        F.col(key).alias("url"), F.lit(record_type).alias("record_type"), at.alias("first_seen_at")
    )
