"""Connected components by alternating large-star and small-star rounds; each round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours are tied to the least node around it."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = both.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node it reaches) for every node of the edges (a, b) over longs."""
    held = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        held = written(_stars(_stars(held, large=True), large=False), "stars")
        now = held.select(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(now) == mark:
            return held.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                held.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = tuple(now)
