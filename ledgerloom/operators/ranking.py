"""Top-k, limits over new rows, and first responders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.operators.dedup import exclude_seen
from ledgerloom.session import written


MERGE_GROUPS = 256


def top_rows(df: DataFrame, order: Sequence[Column], k: int, groups: int = MERGE_GROUPS) -> DataFrame:
    """The first ``k`` rows in a total order, merged in two steps.

    Spark's own top-k sends ``k`` rows of every input task to a single task, too many with hundreds of
    thousands of input tasks. Here each input task keeps ``k`` rows, tasks are merged in groups,
    and only the groups' ``k`` rows each reach the last step. Any grouping gives the same rows.
    """
    window = Window.partitionBy("_group").orderBy(*order)
    best = (
        df.withColumn("_group", F.spark_partition_id() % groups)
        .withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= k)
        .drop("_group", "_rank")
    )
    return best.orderBy(*order).limit(k)


LOCAL_BITS = 33  # of Spark's own row ids, below the number of the partition


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number") -> DataFrame:
    """Rows with their number from 1 in a total order, without bringing them into one task.

    Rows are range-partitioned and sorted, and written with their place in their partition; a partition's first number is the sum of the
    rows before it, one count per partition. Rows that tie in the whole order are numbered in any order among themselves.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sorted_.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part, local = F.shiftright("_place", LOCAL_BITS), F.col("_place").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    counts = sorted((r.part, r.n) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for number, n in counts:
        starts.append((number, before))
        before += n
    offsets = df.sparkSession.createDataFrame(starts, "_part bigint, _before bigint")  # a row per partition
    rows = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return rows.withColumn(name, F.col("_before") + local + 1).drop("_part", "_before", "_place")


def prominence_order(top: Column, size: Column, *seq: Column) -> list[Column]:
    """Flagged rows first, then larger ones, then landing order; missing values come last."""
    return [
        F.coalesce(top, F.lit(False)).desc(),
        F.coalesce(size, F.lit(0)).desc(),
        *[c.asc() for c in seq],
    ]


def prominence_topk(df: DataFrame, top: str, size: str, k: int, *seq: str) -> DataFrame:
    order = prominence_order(F.col(top), F.col(size), *[F.col(c) for c in seq])
    return top_rows(df, order, k)


def limit_new(df: DataFrame, seen: DataFrame, key: str, k: int, *seq: str) -> DataFrame:
    """The first ``k`` rows in landing order whose key was not seen; seen rows use up no quota."""
    return top_rows(exclude_seen(df, seen, key), [F.col(c).asc() for c in seq], k)


def newest_first(df: DataFrame, published: str, k: int, *seq: str) -> DataFrame:
    return top_rows(df, [F.col(published).desc(), *[F.col(c).asc() for c in seq]], k)


def first_success(df: DataFrame, keys: Sequence[str], rank: str, success: Column, keep: Sequence[str]) -> DataFrame:
    """Per key the successful row of lowest rank; keys without success are dropped."""
    return (
        df.where(success)
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*keep), F.col(rank)).alias("_best"))
        .select(*keys, "_best.*")
    )
