"""The same work on streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerloom.functions.dates import is_fresh
from ledgerloom.operators.dedup import exclude_seen_small_batch, first_per_key
from ledgerloom.operators.ingest import SAVED, freshness_reason, keys_to_mark
from ledgerloom.sinks.store import seen_bucket


def event_time(published: Column, arrival: Column) -> Column:
    """The watermark column: the published time, or for dateless rows the arrival time."""
    return F.coalesce(published, arrival)


def fresh_only(stream: DataFrame, ts: str, now: Column) -> DataFrame:
    return stream.where(is_fresh(F.col(ts), now))


def bounded_dedup(stream: DataFrame, key: str, ts: str, delay: str = "24 hours") -> DataFrame:
    """One row per key within the watermark delay. State is dropped after it, so a key may return
    later, unlike in ``ingest_stream``, which remembers every key."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


class StreamTables:
    """The tables that a stream writes, one folder per micro-batch; seen keys are filed by a hash bucket below it."""

    def __init__(self, spark: SparkSession, root: str, key: str, schema: str, key_type: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key
        self.schema = schema
        self.key_schema = f"{key} {key_type}"
        self.run = uuid.uuid4().hex

    def _folder(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def prepare(self) -> None:
        """Create both tables with an empty batch, so that they can be read from the start."""
        for table, schema in (("saved", self.schema), ("seen", f"{self.key_schema}")):
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("overwrite").parquet(self._folder(table, -1) + ("/bucket=0" if table == "seen" else ""))

    def saved(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, batch_id bigint").parquet(f"{self.root}/saved")

    def seen(self, batch_id: int, keys: DataFrame | None = None) -> DataFrame:
        """Keys written by earlier micro-batches; with ``keys``, only of the buckets that they fall into."""
        table = self.spark.read.schema(f"{self.key_schema}, batch_id bigint, bucket int").parquet(f"{self.root}/seen")
        table = table.where(F.col("batch_id") < batch_id)
        if keys is not None:  # a number for each bucket at most
            wanted = [r.bucket for r in keys.select(self._bucket()).distinct().collect()]
            table = table.where(F.col("bucket").isin(wanted))
        return table.drop("bucket")

    def _bucket(self) -> Column:
        return seen_bucket(F.col(self.key)).alias("bucket")

    def write(self, df: DataFrame, table: str, batch_id: int) -> None:
        if table == "seen":
            filed = df.select(self.key, self._bucket()).repartition("bucket")
            filed.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(table, batch_id))
        else:
            df.write.mode("overwrite").parquet(self._folder(table, batch_id))

    def stage(self, df: DataFrame) -> DataFrame:
        """A micro-batch written once, so that its several uses do not compute it again."""
        folder = f"{self.root}/staged/{self.run}"  # of this query alone
        df.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)


def ingest_stream(
    stream: DataFrame,
    tables: StreamTables,
    seq: list[str],
    checkpoint: str,
    now: Column | None = None,
    ts: str | None = None,
    dateless: str = "keep",
    mark_rejected: bool = True,
) -> DataStreamWriter:
    """Each key once over the life of the stream, the first row in landing order.

    With ``ts`` and ``now``, rows that are not fresh are rejected and their keys remembered. A
    replayed micro-batch replaces its own folders and does not see its own keys.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        reason = F.lit(None).cast("string") if ts is None else freshness_reason(F.col(ts), now, dateless)
        firsts = first_per_key(batch.where(F.col(tables.key).isNotNull()), [tables.key], *seq)
        firsts = tables.stage(firsts.withColumn("outcome", F.coalesce(reason, F.lit(SAVED))))
        fresh = exclude_seen_small_batch(firsts, tables.seen(batch_id, firsts), tables.key)
        tables.write(fresh.where(F.col("outcome") == SAVED).drop("outcome"), "saved", batch_id)
        tables.write(keys_to_mark(fresh, tables.key, mark_rejected), "seen", batch_id)

    return stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)


