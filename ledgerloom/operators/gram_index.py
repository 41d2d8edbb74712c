"""Search for a text inside columns through an inverted index of its three-letter grams.

A row that contains a query contains all of the query's grams. The lists of the query's rarest grams are intersected, the rows behind
what is left are read, and the containment itself decides, so the answer is that of a scan. Lists are filed by gram and rows
by key, sorted and with Bloom filters, so a search opens a few row groups of either.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.report import search_predicate
from ledgerloom.session import PUSHED_VALUES

GRAM = 3
BUCKETS = 64
LISTS_READ = 4  # the rarest ones; the check of the text decides the rest
_FILES = {
    "parquet.block.size": str(4 << 20),
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number": "12",
    "parquet.bloom.filter.max.bytes": str(1 << 20),
}


def grams(text: Column) -> Column:
    """The distinct grams of a text in lower case; none if it is shorter."""
    low = F.lower(F.coalesce(text, F.lit("")))
    starts = F.when(F.char_length(low) >= GRAM, F.sequence(F.lit(1), F.char_length(low) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda at: F.substring(low, at, F.lit(GRAM))))


class GramIndex:
    """An index over rows with a text column ``key``, kept in a folder.

    ``columns`` are searched, each under its name in ``columns`` (names of the stored rows). Keys need not be unique; rows with
    a null key are kept and found like others.
    """

    def __init__(self, spark: SparkSession, folder: str, columns: Mapping[str, Column]):
        self.spark, self.folder, self.columns = spark, folder.rstrip("/"), dict(columns)

    def build(self, rows: DataFrame, key: str) -> GramIndex:
        """Write the rows, the lists and the lists' lengths. A text is read once; a frequent gram's list lies in many files."""
        keyed = rows.select(F.coalesce(F.col(key), F.lit("")).alias("key"), *[c.alias(n) for n, c in self.columns.items()])
        options = {"parquet.bloom.filter.enabled#key": "true", **_FILES}
        keyed.repartitionByRange("key").sortWithinPartitions("key").write.mode("overwrite").options(**options).parquet(f"{self.folder}/rows")
        stored = self._rows()
        found = F.array_distinct(F.flatten(F.array(*[grams(F.col(n)) for n in self.columns])))
        lists = stored.select(F.explode(found).alias("gram"), "key").distinct()
        filed = lists.withColumn("bucket", self._bucket(F.col("gram"))).repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(16)))
        options = {"parquet.bloom.filter.enabled#gram": "true", **_FILES}
        filed.sortWithinPartitions("bucket", "gram").write.mode("overwrite").options(**options).partitionBy("bucket").parquet(f"{self.folder}/lists")
        lengths = self._lists().groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
        lengths.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/lengths")
        return self

    def _bucket(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")

    def _rows(self) -> DataFrame:
        fields = ", ".join(f"`{n}` string" for n in ("key", *self.columns))
        return self.spark.read.schema(fields).parquet(f"{self.folder}/rows")

    def _lists(self) -> DataFrame:
        return self.spark.read.schema("gram string, key string, bucket int").parquet(f"{self.folder}/lists")

    def candidates(self, query: str) -> DataFrame | None:
        """The keys whose rows hold the query's rarest grams; None for a query that is too short for the index."""
        low = query.lower()
        wanted = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})[:PUSHED_VALUES]
        if not wanted:
            return None
        own = self.spark.createDataFrame([(g,) for g in wanted], "gram string").select(self._bucket(F.col("gram")).alias("bucket"))
        buckets = [r.bucket for r in own.distinct().collect()]
        lengths = self.spark.read.schema("gram string, n bigint, bucket int").parquet(f"{self.folder}/lengths")
        known = {r.gram: r.n for r in lengths.where(F.col("bucket").isin(buckets) & F.col("gram").isin(wanted)).collect()}
        lists = self._lists()
        if len(known) < len(wanted):
            return lists.select("key").where(F.lit(False))
        rarest = sorted(wanted, key=lambda g: (known[g], g))[:LISTS_READ]
        part = lists.where(F.col("bucket").isin(buckets) & F.col("gram").isin(rarest))
        return part.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rarest)).select("key")

    def search(self, query: str) -> DataFrame:
        """The rows (``key`` and the columns) in which a column contains the query, ignoring case."""
        rows, hit = self._rows(), search_predicate(query, *[F.col(f"`{n}`") for n in self.columns])
        keys = self.candidates(query)
        if keys is None:
            return rows.where(hit)
        few = [r.key for r in keys.limit(PUSHED_VALUES + 1).collect()]
        if len(few) <= PUSHED_VALUES:
            return rows.where(F.col("key").isin(few) & hit)
        return rows.join(keys, "key", "left_semi").where(hit)
