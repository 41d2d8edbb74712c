"""Queries that run a stream to completion over the events and read its tables back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.tables import utc
from ledgerloom.session import configure, run_folder, written
from ledgerloom.sinks.batch_log import BatchLog
from ledgerloom.streaming.ingest import StreamTables, bounded_dedup, event_time, fresh_only, ingest_stream
from ledgerloom.streaming.keyed import ingest_keyed, merged_feeds, seen_keys

NOW = "2024-01-25T00:00:00Z"
ROW = "url string, event_id bigint, event_type string, published timestamp"


LANDINGS = 4
RETURN_LANDINGS = 6


def _landings(spark: SparkSession, sf: str, folder: str) -> Iterator[None]:
    """Land the events in order of their ids, a quarter at a time; each step is one landing of any number of files."""
    events = configure(spark).read.parquet(f"{sf}/events.parquet")
    last = events.agg(F.max("event_id")).first()[0] or 0
    quarter = F.floor(F.col("event_id") * LANDINGS / (last + 1))
    for number in range(LANDINGS):
        events.where(quarter == number).write.mode("append").parquet(folder)
        yield


def event_stream(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Landed events as a stream with a repeating key; errors have no date."""
    schema = configure(spark).read.parquet(f"{sf}/events.parquet").schema
    rows = spark.readStream.schema(schema).parquet(folder)
    ts = F.col("ts").cast("timestamp")
    return rows.select(
        F.concat_ws(":", "user_id", "event_type").alias("url"),
        "event_id",
        "event_type",
        F.when(F.col("event_type") != "error", ts).alias("published"),
        ts.alias("arrival"),
    )


def run_ingest(spark: SparkSession, sf: str, label: str, **options) -> StreamTables:
    """The ingest stopped and started again after each landing, over the same checkpoint."""
    root = run_folder(spark, label)
    tables = StreamTables(spark, f"{root}/tables", "url", ROW, "string")
    tables.prepare()
    for _ in _landings(spark, sf, f"{root}/landed"):
        rows = event_stream(spark, sf, f"{root}/landed").drop("arrival")
        writer = ingest_stream(rows, tables, ["event_id"], f"{root}/checkpoint", **options)
        writer.trigger(availableNow=True).start().awaitTermination()
    return tables


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """One row per key over the stream, the first in landing order."""
    return run_ingest(spark, sf, "stream-dedup").saved().select("url", "event_id")


def stream_fresh(spark: SparkSession, sf: str) -> DataFrame:
    """Fresh and dateless rows are saved, stale keys are remembered: rows per table and kind."""
    tables = run_ingest(spark, sf, "stream-fresh", now=utc(NOW), ts="published")
    saved = tables.saved().groupBy("event_type").agg(F.count(F.lit(1)).alias("saved"))
    kind = F.element_at(F.split("url", ":"), -1).alias("event_type")
    seen = tables.seen(1 << 62).groupBy(kind).agg(F.count(F.lit(1)).alias("seen"))
    return seen.join(saved, "event_type", "left").select("event_type", F.coalesce("saved", F.lit(0)).alias("saved"), "seen")


def run_keyed(spark: SparkSession, sf: str, label: str, **options) -> tuple[BatchLog, str]:
    """The ingest on a state store, stopped and started again after each landing; the log of saved rows, and the checkpoint."""
    root = run_folder(spark, label)
    log = BatchLog(spark, f"{root}/saved", ROW)
    for _ in _landings(spark, sf, f"{root}/landed"):
        rows = event_stream(spark, sf, f"{root}/landed").drop("arrival")
        writer = ingest_keyed(rows, log, "url", ["event_id"], f"{root}/checkpoint", **options)
        writer.trigger(availableNow=True).start().awaitTermination()
    return log, f"{root}/checkpoint"


def stream_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """One row per key over the stream, the first in landing order, with the keys in the stream's own state."""
    return run_keyed(spark, sf, "stream-keyed")[0].read().select("url", "event_id")


def stream_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Fresh and dateless rows are saved, stale keys are remembered: rows saved, and keys in the exported state, per kind."""
    log, checkpoint = run_keyed(spark, sf, "stream-keys", now=utc(NOW), ts="published")
    saved = log.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("saved"))
    kind = F.element_at(F.split("url", ":"), -1).alias("event_type")
    seen = seen_keys(spark, checkpoint, "url").groupBy(kind).agg(F.count(F.lit(1)).alias("seen"))
    return seen.join(saved, "event_type", "left").select("event_type", F.coalesce("saved", F.lit(0)).alias("saved"), "seen")


def _to_files(spark: SparkSession, sf: str, label: str, shape: Callable[[DataFrame], DataFrame]) -> DataFrame:
    root = run_folder(spark, label)
    for _ in _landings(spark, sf, f"{root}/landed"):
        stream = shape(event_stream(spark, sf, f"{root}/landed"))
        writer = stream.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def stream_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """Keys after bounded-state dedup on published or, without one, arrival time."""

    def shape(events: DataFrame) -> DataFrame:
        rows = events.select("url", event_time(F.col("published"), F.col("arrival")).alias("event_ts"))
        return bounded_dedup(rows, "url", "event_ts", "60 days").select("url")

    return _to_files(spark, sf, "stream-bounded", shape)


def stream_returns(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds with delays of 6 and 36 hours, landed in order of time: keys that come again after their state is gone are saved again."""
    events = configure(spark).read.parquet(f"{sf}/events.parquet")
    root, (low, high) = run_folder(spark, "stream-returns"), events.agg(F.min("ts"), F.max("ts")).first()
    quarter = F.least(F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(low).cast("timestamp"))) * RETURN_LANDINGS
                              / (F.unix_micros(F.lit(high).cast("timestamp")) - F.unix_micros(F.lit(low).cast("timestamp")))), F.lit(RETURN_LANDINGS - 1))
    landed = events.select(
        F.concat_ws(":", "user_id", "event_type").alias("url"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("fast")).otherwise(F.lit("slow")).alias("feed"), quarter.alias("landing"),
    )
    landed = written(landed, "returns")
    for number in range(RETURN_LANDINGS):
        landed.where(F.col("landing") == number).drop("landing").coalesce(1).write.mode("append").partitionBy("feed").parquet(f"{root}/landed")
        rows = {f: spark.readStream.schema("url string, event_id bigint, ts timestamp").parquet(f"{root}/landed/feed={f}") for f in ("fast", "slow")}
        merged = merged_feeds([(rows["fast"], "6 hours"), (rows["slow"], "36 hours")], "url", "ts", ["ts", "event_id"])
        writer = merged.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("url string, event_id bigint, ts timestamp").parquet(f"{root}/rows").select("url", "event_id")


def stream_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The freshness gate alone: rows whose date is known and fresh."""
    return _to_files(spark, sf, "stream-gate", lambda events: fresh_only(events, "published", utc(NOW)).select("event_id"))


_ROWS = """SELECT user_id || ':' || event_type AS url, event_id, event_type,
    CASE WHEN event_type <> 'error' THEN ts END AS published FROM events"""
_FIRST = f"SELECT url, min(event_id) AS event_id, any_value(event_type) AS event_type, arg_min(published, event_id) AS published FROM ({_ROWS}) GROUP BY url"

QUERIES = {
    "stream_dedup": stream_dedup,
    "stream_fresh": stream_fresh,
    "stream_keyed": stream_keyed,
    "stream_keys": stream_keys,
    "stream_bounded": stream_bounded,
    "stream_gate": stream_gate,
    "stream_returns": stream_returns,
}

_FRESH = f"""SELECT event_type, count(*) FILTER (published IS NULL OR published >= TIMESTAMP '2024-01-24') AS saved,
        count(*) AS seen FROM (SELECT f.url, f.event_type, e.published FROM ({_FIRST}) f JOIN ({_ROWS}) e USING (event_id))
      GROUP BY event_type"""

# The watermark behind each landing is the least of both feeds' greatest times, of first rows, less their delays; keys are held for 36 hours.
_RETURNS = f"""WITH RECURSIVE e AS (SELECT user_id || ':' || event_type AS url, event_id, epoch_us(ts) AS t, event_type IN ('view', 'click') AS fast,
      least((epoch_us(ts) - low) * {RETURN_LANDINGS} // (high - low), {RETURN_LANDINGS - 1}) AS i
      FROM events, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events)),
    f AS (SELECT url, i, arg_min(event_id, (t, event_id)) AS event_id, min(t) AS t, any_value(fast) AS fast FROM e GROUP BY url, i),
    w AS (SELECT n AS i, least((SELECT max(t) FROM f WHERE fast AND i < n) - 21600000000, (SELECT max(t) FROM f WHERE NOT fast AND i < n) - 129600000000) AS mark
      FROM range({RETURN_LANDINGS}) r(n)),
    r AS (SELECT DISTINCT -1::BIGINT AS i, url, NULL::BIGINT AS gone, NULL::BIGINT AS event_id FROM e UNION ALL
      SELECT r.i + 1, r.url, CASE WHEN f.t IS NOT NULL AND (r.gone IS NULL OR r.gone <= w.mark) THEN f.t + 129600000000 WHEN r.gone <= w.mark THEN NULL ELSE r.gone END,
        CASE WHEN f.t IS NOT NULL AND (r.gone IS NULL OR r.gone <= w.mark) THEN f.event_id END
      FROM r JOIN w ON w.i = r.i + 1 LEFT JOIN f ON f.url = r.url AND f.i = r.i + 1)
  SELECT url, event_id FROM r WHERE event_id IS NOT NULL"""

ORACLE = {
    "stream_returns": _RETURNS,
    "stream_dedup": f"SELECT url, event_id FROM ({_FIRST})",
    "stream_fresh": _FRESH,
    "stream_keyed": f"SELECT url, event_id FROM ({_FIRST})",
    "stream_keys": _FRESH,
    "stream_bounded": f"SELECT DISTINCT url FROM ({_ROWS})",
    "stream_gate": f"SELECT event_id FROM ({_ROWS}) WHERE published >= TIMESTAMP '2024-01-24'",
}
