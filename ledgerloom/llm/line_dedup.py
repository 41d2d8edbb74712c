"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

The index keeps, in one folder, three tables with a ``batch`` partition each:

- ``holders`` (key, doc_id, live): which document holds which line key; the newest row counts,
- ``refs`` (key, n_docs, last_doc): exact reference counts; the newest row of a key counts,
- ``filters`` (shard, filter): one cuckoo filter per shard of the key space over all counted keys.

An insert asks the filters first. A key that they do not know is new for certain, so its count is the
batch's own and no older row is read. Only keys that they may know are recounted from ``holders``. A
delete recounts the keys of the deleted documents and takes keys without holders out of the filters, so
that inserting and deleting a document leaves the counts as they were. Which keys enter and leave the filters
is decided by the live rows of ``refs``: every counted key has a fingerprint of its own, also one that looks known.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.texts import SPACE, hold_only
from ledgerloom.session import run_folder

MIN_CHARS = 20
MIN_DOCS = 3
KEYS_PER_SHARD = 200_000
SLOTS = 4


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit digest of the stripped, lower-cased line; None for a line that is too short to count."""
    core = line.strip(SPACE)
    return hashlib.blake2b(core.encode().lower(), digest_size=16).digest() if len(core) >= min_chars else None


class CuckooFilter:
    """16-bit fingerprints in buckets of four; grows by adding a larger level, so no key has to be known again."""

    def __init__(self, capacity: int):
        self.levels = [self._level(capacity)]
        self.stash: list[int] = []

    @staticmethod
    def _level(capacity: int) -> np.ndarray:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / SLOTS / 0.8))))
        return np.zeros((buckets, SLOTS), np.uint16)

    @staticmethod
    def _places(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(table) - 1)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (hashes & mask).astype(np.int64)
        return prints, first, CuckooFilter._other(table, first, prints)

    @staticmethod
    def _other(table: np.ndarray, place: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return place ^ (prints.astype(np.int64) * 0x5BD1E995 & (len(table) - 1))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        found = np.isin(hashes, np.array(self.stash, np.uint64))
        for table in self.levels:
            prints, first, second = self._places(table, hashes)
            found |= (table[first] == prints[:, None]).any(1) | (table[second] == prints[:, None]).any(1)
        return found

    def insert(self, hashes: np.ndarray) -> None:
        """Add keys that were not added yet, or were deleted; each gets a fingerprint of its own."""
        table = self.levels[-1]
        room = int(table.size * 0.9) - int(np.count_nonzero(table))
        if room < len(hashes):
            self._fill(table, hashes[: max(0, room)])
            self.levels.append(self._level(max(2 * table.size, 2 * len(hashes))))
            hashes = hashes[max(0, room) :]
        self._fill(self.levels[-1], hashes)

    def _fill(self, table: np.ndarray, hashes: np.ndarray) -> None:
        prints, place, second = self._places(table, hashes)
        for turn in (0, 1):
            order = np.argsort((place, second)[turn], kind="stable")
            prints, place, second = prints[order], place[order], second[order]
            places = (place, second)[turn]
            start = np.r_[True, places[1:] != places[:-1]]
            rank = np.arange(len(places)) - np.maximum.accumulate(np.where(start, np.arange(len(places)), 0))
            free = table[places] == 0
            fits = rank < free.sum(1)
            slot = np.argmax(np.cumsum(free, 1) == (rank + 1)[:, None], 1)
            table[places[fits], slot[fits]] = prints[fits]
            prints, place, second = prints[~fits], place[~fits], second[~fits]
        for mark, bucket in zip(prints, place.tolist(), strict=True):
            for kick in range(200):
                empty = np.flatnonzero(table[bucket] == 0)
                if len(empty):
                    table[bucket, empty[0]] = mark
                    break
                out = table[bucket, kick % SLOTS]
                table[bucket, kick % SLOTS], mark = mark, out
                bucket = int(self._other(table, np.array([bucket]), np.array([mark]))[0])
            else:  # the fingerprint that is left over cannot be named by a key: a level of its own keeps it findable
                spill = np.zeros_like(table)
                spill[bucket, 0] = mark
                self.levels.insert(0, spill)

    def delete(self, hashes: np.ndarray) -> None:
        """Remove keys that were added.

        In levels of one size equal fingerprints in a key's buckets can stand for one another. Where levels of several
        sizes have it, the key's own one is not known and all stay, as taking another key's would lose that key.
        """
        for key in hashes:
            hits = []
            for table in self.levels:
                prints, first, second = self._places(table, np.array([key], np.uint64))
                hits += [(table, b, s) for b in (first[0], second[0]) for s in range(SLOTS) if table[b, s] == prints[0]][:1]
            if len({len(table) for table, _, _ in hits}) == 1:
                table, bucket, slot = hits[0]
                table[bucket, slot] = 0


def _hashes(keys: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0].astype(np.uint64)


def _probe_filter(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """One shard: flags the batch's keys as known or new."""
    blobs, names = filters.column("filter").to_pylist(), keys.column("key").to_pylist()
    seen = pickle.loads(blobs[0]).contains(_hashes(names)).tolist() if blobs else [False] * len(names)
    return pa.table({"key": pa.array(names, pa.binary()), "known": pa.array(seen, pa.bool_())})


def _update_filter(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """One shard: the filter after the batch's deletes and inserts."""
    blobs = filters.column("filter").to_pylist()
    shard = (keys.column("shard") if keys.num_rows else filters.column("shard"))[0].as_py()
    held = pickle.loads(blobs[0]) if blobs else CuckooFilter(max(KEYS_PER_SHARD // 8, keys.num_rows))
    hashes, gone = _hashes(keys.column("key").to_pylist()), np.array(keys.column("gone").to_pylist(), bool)
    held.delete(hashes[gone])
    held.insert(hashes[~gone])
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([pickle.dumps(held)], pa.binary())})


class LineIndex:
    """Line counts of the documents inserted so far. Rows without ``doc_id`` are neither counted nor changed.

    A folder that an index was kept in is opened as it was after its last finished batch. A batch counts once its state is written, the
    last thing it writes; what a lost driver left of an unfinished one is not read, and the next batch takes its place.

    Rows with the same ``doc_id`` are one document. Null or empty text is one empty line; extra columns are ignored.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.min_chars, self.min_docs = spark, min_chars, min_docs
        self.folder = folder or run_folder(spark, "lines")
        self.batch, self.shards = self._last_state() if folder else (0, 0)

    def _last_state(self) -> tuple[int, int]:
        """Number of the last finished batch and of shards, as the folder has them."""
        try:
            states = self.spark.read.schema("number int, shards int").option("recursiveFileLookup", "true").parquet(f"{self.folder}/state")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, 0
        last = states.agg(F.max(F.struct("number", "shards"))).first()[0]
        return tuple(last) if last else (0, 0)

    def _finish(self, batch: int) -> None:
        state = self.spark.createDataFrame([(batch, self.shards)], "number int, shards int").coalesce(1)
        state.write.mode("overwrite").parquet(f"{self.folder}/state/{batch}")
        self.batch = batch

    def holdings(self, docs: DataFrame) -> DataFrame:
        """Each document's distinct counted line keys."""
        least = self.min_chars

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hold_only(None)
            for batch in batches:
                ids, found = [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    own = {line_key(line, least) for line in (text or "").split("\n")} - {None}
                    ids += [doc] * len(own)
                    found += own
                yield pa.record_batch([pa.array(found, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

        named = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
        return named.mapInArrow(keys, "key binary, doc_id long")

    def _path(self, table: str, batch: int | None = None) -> str:
        return f"{self.folder}/{table}" + ("" if batch is None else f"/batch={batch}")

    def _read(self, table: str, schema: str, batch: int | None = None) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._path(table, batch))

    def refs(self, keys: DataFrame | None = None) -> DataFrame:
        """Exact reference counts: key, n_docs, last_doc; with ``keys``, of these only."""
        only = (lambda rows: rows) if keys is None else lambda rows: rows.join(keys.select("key"), "key", "left_semi")
        if not self.batch:
            return self.spark.createDataFrame([], "key binary, n_docs long, last_doc long")
        if self.batch == 1:
            return only(self._read("refs", "key binary, n_docs long, last_doc long", 1))
        rows = only(self._read("refs", "key binary, n_docs long, last_doc long, batch int").where(F.col("batch") <= self.batch))
        newest = rows.groupBy("key").agg(F.max_by(F.struct("n_docs", "last_doc"), "batch").alias("x"))
        return newest.select("key", "x.*").where("n_docs > 0")

    def _recount(self, keys: DataFrame, batch: int) -> DataFrame:
        """Counts of the keys over the holders of all batches up to this one."""
        held = self._read("holders", "key binary, doc_id long, live boolean, batch int").where(F.col("batch") <= batch)
        rows = held.join(keys.select("key"), "key", "left_semi")
        newest = rows.groupBy("key", "doc_id").agg(F.max_by("live", "batch").alias("live"))
        return newest.groupBy("key").agg(F.count_if("live").alias("n_docs"), F.max(F.when(F.col("live"), F.col("doc_id"))).alias("last_doc"))

    def _shard(self) -> F.Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def _filters(self, batch: int) -> DataFrame:
        if not batch:
            return self.spark.createDataFrame([], "shard int, filter binary")
        return self._read("filters", "shard int, filter binary", batch)

    def _probed(self, keys: DataFrame, batch: int) -> DataFrame:
        """The batch's keys with ``known``, by the filters as they were before it."""
        dealt, old = keys.select(self._shard(), "key").groupBy("shard"), self._filters(batch - 1).groupBy("shard")
        dealt.cogroup(old).applyInArrow(_probe_filter, "key binary, known boolean").write.mode("overwrite").parquet(self._path("probed", batch))
        return self._read("probed", "key binary, known boolean", batch)

    def _refilter(self, keys: DataFrame, gone: bool, batch: int) -> None:
        """Write the filters as they are after the batch: with the keys, or without them if they are ``gone``."""
        dealt = keys.select(self._shard(), "key", F.lit(gone).alias("gone")).groupBy("shard")
        new = dealt.cogroup(self._filters(batch - 1).groupBy("shard")).applyInArrow(_update_filter, "shard int, filter binary")
        new.write.mode("overwrite").parquet(self._path("filters", batch))

    def insert_in_batches(self, docs: DataFrame, batches: int) -> LineIndex:
        """Insert documents in several batches, dealt by their ids; the filters tell which keys of a batch the earlier ones know."""
        for number in range(batches):
            self.insert(docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(batches)) == number))
        return self

    def insert(self, docs: DataFrame) -> LineIndex:
        batch = self.batch + 1
        held = self.holdings(docs).distinct().withColumn("live", F.lit(True))
        held.write.mode("overwrite").parquet(self._path("holders", batch))
        mine = self._read("holders", "key binary, doc_id long, live boolean", batch)
        counts = mine.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        if not self.shards:  # settled by the first batch; later growth adds levels to the filters
            self.shards = 1 + mine.select(F.approx_count_distinct("key")).first()[0] // KEYS_PER_SHARD
        if not self.batch:  # nothing was known before
            fresh = refs = counts
        else:
            probed = self._probed(counts, batch)
            known = probed.where("known")
            fresh = counts.join(self.refs(known).select("key"), "key", "left_anti")
            refs = counts.join(probed.where("NOT known").select("key"), "key", "left_semi").unionByName(self._recount(known, batch))
        self._refilter(fresh, False, batch)
        refs.write.mode("overwrite").parquet(self._path("refs", batch))
        self._finish(batch)
        return self

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take documents out again; ``docs`` are their rows as inserted."""
        batch = self.batch + 1
        held = self.holdings(docs).distinct().withColumn("live", F.lit(False))
        held.write.mode("overwrite").parquet(self._path("holders", batch))
        touched = self._read("holders", "key binary, doc_id long, live boolean", batch).select("key").distinct()
        self._recount(touched, batch).write.mode("overwrite").parquet(self._path("refs", batch))
        none_left = self._read("refs", "key binary, n_docs long, last_doc long", batch).where("n_docs = 0")
        live_before = self.refs(touched) if batch > 1 else none_left.limit(0)
        self._refilter(none_left.join(live_before.select("key"), "key", "left_semi"), True, batch)
        self._finish(batch)
        return self

    def clean(self, docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """doc_id, the carried columns, the text without dropped lines, n_lines and n_dropped; a row per input row."""
        least = self.min_chars
        often = self.refs().where(F.col("n_docs") >= self.min_docs).select("key", "last_doc")
        drops = self.holdings(docs).join(often, "key").where("doc_id <> last_doc").groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, "text")
        fields = {f.name: f for f in rows.schema.fields}
        out = ", ".join(f"`{n}` {fields[n].dataType.simpleString()}" for n in fields) + ", n_lines long, n_dropped long"

        def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hold_only(None)
            for batch in batches:
                texts, lines_in, lines_out = [], [], []
                for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                    lines = (text or "").split("\n")
                    lines_in.append(len(lines))
                    if gone:
                        drop = set(gone)
                        kept = [line for line in lines if line_key(line, least) not in drop]
                        lines_out.append(len(lines) - len(kept))
                        texts.append("\n".join(kept))
                    else:
                        lines_out.append(0)
                        texts.append(text)
                columns = [batch.column(n) for n in fields if n != "text"]
                yield pa.record_batch(
                    [*columns, pa.array(texts, pa.string()), pa.array(lines_in, pa.int64()), pa.array(lines_out, pa.int64())],
                    names=[*(n for n in fields if n != "text"), "text", "n_lines", "n_dropped"],
                )

        return rows.join(drops, "doc_id", "left").select(*fields, "gone").mapInArrow(strip, out)
