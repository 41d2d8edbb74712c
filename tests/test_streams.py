from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.streaming.ingest import StreamTables, bounded_dedup, event_time, fresh_only, ingest_stream

NOW = datetime(2026, 7, 19, 12)
NOW_COL = F.lit("2026-07-19T12:00:00Z").cast("timestamp")
ROW = "url string, seq bigint, published timestamp"


@pytest.fixture
def landing(spark, tmp_path):
    """Three files of one row each per step, read in the order they were written."""
    path = str(tmp_path / "landing")

    def write(*rows):
        spark.createDataFrame(list(rows), ROW).coalesce(1).write.mode("append").parquet(path)

    write(("a", 1, NOW), ("a", 2, NOW), ("b", 3, NOW - timedelta(days=5)))
    write(("b", 4, NOW), ("c", 5, None), ("a", 6, NOW))
    write(("d", 7, NOW - timedelta(hours=24)), (None, 8, NOW), ("c", 9, NOW))
    return path


def stream(spark, path):
    return spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, path, root, **options):
    tables = StreamTables(spark, f"{root}/tables", "url", ROW, "string")
    tables.prepare()
    writer = ingest_stream(stream(spark, path), tables, ["seq"], f"{root}/checkpoint", **options)
    writer.trigger(availableNow=True).start().awaitTermination()
    return tables


def rows(tables):
    return {r.url: r.seq for r in tables.saved().collect()}


def test_first_row_per_key_over_all_batches(spark, landing, tmp_path):
    tables = run(spark, landing, str(tmp_path / "run"))
    assert rows(tables) == {"a": 1, "b": 3, "c": 5, "d": 7}
    assert tables.saved().count() == 4 and tables.seen(99).count() == 4


def test_stale_rows_are_remembered(spark, landing, tmp_path):
    tables = run(spark, landing, str(tmp_path / "run"), now=NOW_COL, ts="published")
    assert rows(tables) == {"a": 1, "c": 5, "d": 7}
    assert {r.url for r in tables.seen(99).collect()} == {"a", "b", "c", "d"}


def test_unmarked_rejections_may_return(spark, landing, tmp_path):
    tables = run(spark, landing, str(tmp_path / "run"), now=NOW_COL, ts="published", dateless="drop", mark_rejected=False)
    assert rows(tables) == {"a": 1, "b": 4, "c": 9, "d": 7}


def test_restart_adds_nothing_and_new_files_continue(spark, landing, tmp_path):
    root = str(tmp_path / "run")
    tables = run(spark, landing, root)
    again = StreamTables(spark, f"{root}/tables", "url", ROW, "string")
    spark.createDataFrame([("a", 10, NOW), ("e", 11, NOW)], ROW).coalesce(1).write.mode("append").parquet(landing)
    ingest_stream(stream(spark, landing), again, ["seq"], f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert rows(tables) == {"a": 1, "b": 3, "c": 5, "d": 7, "e": 11}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    tables = StreamTables(spark, str(tmp_path / "tables"), "url", ROW, "string")
    tables.prepare()
    batch = spark.createDataFrame([("a", 1, NOW)], ROW)
    for _ in range(2):
        tables.write(batch, "saved", 0)
        tables.write(batch.select("url"), "seen", 0)
    assert tables.saved().count() == 1 and tables.seen(0).count() == 0 and tables.seen(1).count() == 1


def to_rows(spark, df, root):
    writer = df.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/cp")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/rows").collect()


def test_bounded_dedup_uses_arrival_for_dateless_rows(spark, landing, tmp_path):
    source = stream(spark, landing).select("url", event_time(F.col("published"), NOW_COL).alias("ts"))
    kept = to_rows(spark, bounded_dedup(source.where("url is not null"), "url", "ts", "10 days"), str(tmp_path / "run"))
    assert sorted(r.url for r in kept) == ["a", "b", "c", "d"]


def test_fresh_gate(spark, landing, tmp_path):
    kept = to_rows(spark, fresh_only(stream(spark, landing), "published", NOW_COL), str(tmp_path / "run"))
    assert sorted(r.seq for r in kept) == [1, 2, 4, 6, 7, 8, 9]
