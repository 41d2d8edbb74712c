"""Each key once over the life of a stream, remembered in the stream's own state.

Spark's RocksDB state provider holds the keys of a native ``dropDuplicates`` on the executors' disks; a micro-batch commits only a
changelog of its own keys, so its time and its files do not grow with the keys seen before. No table of seen keys is
written or read: ``seen_keys`` exports them from the checkpoint.

``dropDuplicates`` keeps any one of a micro-batch's rows of a new key. Rows are therefore reduced before it to the first of each
key in landing order, partition by partition of the micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerloom.operators.ingest import MARKED_REJECTIONS, SAVED, freshness_reason
from ledgerloom.sinks.batch_log import BatchLog

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Changelogs, offsets and commits of older micro-batches are deleted; a restart needs the last one only.
    "spark.sql.streaming.minBatchesToRetain": "10",
}
HELD_ROWS = 200_000


def use_state_store(spark: SparkSession) -> SparkSession:
    """Settings that a query reads when it starts; a checkpoint keeps those it was started with."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def _first_of_key(rows: pa.Table, key: str, seq: list[str]) -> pa.Table:
    ordered = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in (key, *seq)])).combine_chunks()
    if ordered.num_rows < 2:
        return ordered
    keys = ordered.column(key)
    starts = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_pylist()
    return ordered.filter(pa.array([True, *starts]))


def first_in_batch(stream: DataFrame, key: str, seq: list[str]) -> DataFrame:
    """One row per key of each micro-batch, the first by ``seq`` (columns that Arrow can sort). Rows with a null key are left out.

    A task holds the distinct keys of its part of the micro-batch, and 200,000 rows beside them.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held[1:]) > HELD_ROWS:
                held = [_first_of_key(pa.concat_tables(held), key, seq)]
        if held:
            yield from _first_of_key(pa.concat_tables(held), key, seq).to_batches()

    return stream.where(F.col(key).isNotNull()).repartition(F.col(key)).mapInArrow(reduce, stream.schema)


def ingest_keyed(
    stream: DataFrame,
    saved: BatchLog,
    key: str,
    seq: list[str],
    checkpoint: str,
    now: Column | None = None,
    ts: str | None = None,
    dateless: str = "keep",
    mark_rejected: bool = True,
) -> DataStreamWriter:
    """The rules of ``ingest_stream`` on a state store: each key once, the first row in landing order.

    With ``ts`` and ``now``, rows that are not fresh are rejected; their keys are remembered if ``mark_rejected``. A replayed
    micro-batch starts from the state before it and replaces its own folder.
    """
    use_state_store(stream.sparkSession)
    reason = F.lit(None).cast("string") if ts is None else freshness_reason(F.col(ts), now, dateless)
    judged = stream.withColumn("outcome", F.coalesce(reason, F.lit(SAVED)))
    firsts = first_in_batch(judged, key, seq)
    remembered = [SAVED, *MARKED_REJECTIONS] if mark_rejected else [SAVED]
    fresh = firsts.where(F.col("outcome").isin(remembered)).dropDuplicates([key])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        saved.write(batch.where(F.col("outcome") == SAVED).drop("outcome"), batch_id)

    return fresh.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)


def merged_feeds(feeds: Sequence[tuple[DataFrame, str]], key: str, ts: str, seq: list[str], policy: str = "min") -> DataFrame:
    """Several feeds of one shape, each with its own delay, and one row per key while its key is remembered.

    A key is remembered for the longest delay after the time of its row, and forgotten once the merged watermark has passed that; it may
    then return. The merged watermark is that of the slowest feed (``min``) or of the fastest (``max``); the policy is a setting of the
    session when the query first starts. A watermark follows the rows that are first of their key in a micro-batch. ``seq`` orders the rows of a key in a micro-batch, as in ``first_in_batch``.
    """
    stream = feeds[0][0]
    use_state_store(stream.sparkSession).conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    longest = lambda feed: F.expr(f"INTERVAL {feed[1]}")
    seconds = stream.sparkSession.range(1).select(*[F.unix_micros(F.timestamp_seconds(F.lit(0)) + longest(f)).alias(f"f{i}") for i, f in enumerate(feeds)]).first()
    merged = None
    for number in sorted(range(len(feeds)), key=lambda i: -seconds[i]):  # the first one's delay is how long the union's keys are held
        rows, delay = feeds[number]
        marked = first_in_batch(rows, key, seq).withWatermark(ts, delay)
        merged = marked if merged is None else merged.unionByName(marked)
    return merged.dropDuplicatesWithinWatermark([key])


def seen_keys(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """The keys that a stream remembers, saved and rejected ones, read from the state of its last finished micro-batch."""
    return spark.read.format("statestore").load(checkpoint).select(F.col("key")[key].alias(key))
