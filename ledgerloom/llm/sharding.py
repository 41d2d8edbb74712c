"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters the records uniformly into buckets by a seeded hash, so many that a bucket fits in memory.
Pass two gives each bucket a Fisher-Yates shuffle (Spark's ``shuffle`` over the bucket's array, seeded) and lays the
buckets end to end: a record's place is the number of records in earlier buckets plus its place in its own. Shards are
stretches of places, so their row counts are at most one apart, and a bucket is written where it was shuffled: a record
crosses one shuffle. The buckets' counts come from a pass over row positions alone.

A record's bucket depends on its position in the input. The input is read twice, so it must give its rows in the same order each
time, as a table does; a bucket with another count than the first pass saw stops the job, so nothing can be lost or doubled. A bucket is
one array: records of a bucket, 64 MB on average, and any single record must stay below Spark's 2 GB for a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ledgerloom.session import run_folder, written

SHARDS = 16
SEED = 20240229
BUCKET_ROWS = 50_000
BUCKET_BYTES = 64 << 20
GROUP = 1024  # buckets whose counts are summed in one go
BROADCAST_BUCKETS = 1_000_000  # 16 MB of starts


def _starts(counts: DataFrame) -> DataFrame:
    """bucket, n, and the number of records in earlier buckets."""
    counts = counts.withColumn("part", F.floor(F.col("bucket") / GROUP))
    whole = counts.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = whole.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("bucket")) - F.col("n")
    joined = counts.select("part", "bucket", "n", inside.alias("within")).join(earlier, "part")
    return joined.select("bucket", "n", (F.col("before") + F.col("within")).alias("start"))


def shuffled(records: DataFrame, size: F.Column, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records in a uniformly random order: their columns in one struct ``record``, their ``place`` from 0, and the ``total``.

    ``size`` is the bytes of a record, for the number of buckets. Equal records are told apart by their position in the
    input, so repeated rows, null keys and groups of copies scatter like any others. With the same input files and seed the
    order comes out the same.
    """
    rows, volume = records.select(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = 1 + max(rows // bucket_rows, volume // bucket_bytes)
    names = [F.col(f"`{n}`") for n in records.columns]
    at = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    bucket = F.pmod("at", F.lit(buckets)).alias("bucket")
    starts = written(_starts(records.select(at.alias("at")).groupBy(bucket).agg(F.count("*").alias("n"))), "bucket-starts")
    scattered = records.select(F.struct(*names).alias("record"), at.alias("at")).select("record", "at", bucket)
    filled = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("at", "record"))).alias("all"))
    placed = filled.join(F.broadcast(starts) if buckets <= BROADCAST_BUCKETS else starts, "bucket", "left").sortWithinPartitions("bucket")
    moved = F.raise_error(F.lit("the input gave its rows in another order the second time; write it to a table first"))
    mixed = placed.select("start", F.when(F.size("all") == F.col("n"), F.shuffle("all", seed)).otherwise(moved).alias("all"))
    each = mixed.select("start", F.posexplode("all").alias("pos", "x"))
    return each.select("x.record", (F.col("start") + F.col("pos")).alias("place"), F.lit(rows).cast("long").alias("total"))


def shard(records: DataFrame, size: F.Column, shards: int = SHARDS, **options) -> DataFrame:
    """``record`` with its ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    The first shards have one record more if the records do not divide evenly.
    """
    placed, place = shuffled(records, size, **options), F.col("place")
    least, larger = F.floor(F.col("total") / shards), F.col("total") % shards
    late = place - larger * (least + 1)  # the place among the shards of the smaller size
    inside = late < 0
    number = F.when(inside, F.floor(place / (least + 1))).otherwise(larger + F.floor(late / F.greatest(least, F.lit(1))))
    slot = F.when(inside, place % (least + 1)).otherwise(late % F.greatest(least, F.lit(1)))
    return placed.select("record", number.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def text_bytes(text: F.Column) -> F.Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _free(columns: list[str], name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def place_columns(docs: DataFrame) -> tuple[str, str]:
    """The names of the shard and the slot in the written files: ``_shard`` and ``_slot`` unless a column has them."""
    return _free(docs.columns, "_shard"), _free(docs.columns, "_slot")


def document_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Writes the shards and reads them back: doc_id, size, text_crc32, shard and slot of every row.

    Null text counts as empty; extra columns are written along, whatever their names.
    """
    folder, (shard_name, slot_name) = run_folder(docs.sparkSession, "shards"), place_columns(docs)
    write_shards(docs, folder, shards)
    places = (StructField(slot_name, LongType()), StructField(shard_name, IntegerType()))
    back = docs.sparkSession.read.schema(StructType([*docs.schema, *places])).parquet(folder)
    return back.select(
        "doc_id", text_bytes(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.col(shard_name).alias("shard"), F.col(slot_name).alias("slot"),
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> None:
    """Write whole documents as Parquet, a folder per shard, each file in slot order."""
    shard_name, slot_name = place_columns(docs)
    placed = shard(docs, text_bytes(F.col("text")), shards)
    named = placed.select("record.*", F.col("shard").alias(shard_name), F.col("slot").alias(slot_name))
    named.sortWithinPartitions(shard_name, slot_name).write.partitionBy(shard_name).parquet(folder)
