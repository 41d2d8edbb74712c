"""Document fingerprints by MinHash, their likeness to an edited text and to the next document, and near texts by bands.

A text's shingles are its runs of five words (white space apart, A-Z in lower case); a shorter text is one shingle, a text without
words has none. Each of 120 universal hash functions x -> (a x + b) mod 2^31 - 1 keeps its least value over all shingles, worked
out in numpy over blocks of shingles; a fingerprint is the low 16 bits of each, so the likeness of two fingerprints, the share of equal
places, estimates the Jaccard similarity of the shingles. Equal texts have equal fingerprints.

``edited`` needs each document's successor by id. A narrow pass over the ids chooses cuts; documents are dealt to the stretches
between them, and the first document of each stretch is sent to the one before as well (that of the first one to the last). So each
text crosses one shuffle, compressed, and a task reads its stretches in order and holds two texts at a time. The cuts come from
a bounded sample of ids and decide only the work of a task, no result.

``near_texts`` posts each text under its signature bands (30 of 4 places; two texts with a Jaccard similarity of 0.8 share one but with a
chance of 1.4 * 10^-7). Of equal texts the least id stands for all. The lists go through ``minhash.linked``: every pair that shares a band is
either connected already or compared, so that also two texts meet that are near each other but not near the head of any list. Two bits of
each place rule pairs out (one at 0.8 with a chance of some 10^-7); the others are verified on their full shingle sets, and classes are
what the verified links connect.

Null texts count as empty; two texts without words have a likeness of 1. A row without an id has no next document: its edited
text is its own first part, its likeness to the next one that to an empty text, and it is near to nothing. Rows that repeat an id stand
in order of their texts' digests. Of a single document the next one is itself. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import minhash
from ledgerloom.llm.components import components
from ledgerloom.llm.texts import BROADCAST_IDS, unzipped, zipped
from ledgerloom.session import written

WORDS = 5
BANDS, PLACES = 30, 4
PERMUTATIONS = BANDS * PLACES
PRIME = (1 << 31) - 1
SHINGLES_AT_ONCE = 1024
PERCENT = 80
LONG = 300  # pairs that a list may make one by one; few lists stay open, and those of large groups of unlike texts make many
STRETCH_ROWS = 2048
MOST_STRETCHES = 100_000
IDS_PER_CUT = 20
OUT_ROWS = 1000

_rng = np.random.default_rng(13)
_FACTORS = _rng.integers(1, PRIME, PERMUTATIONS, dtype=np.uint64)[:, None]
_SHIFTS = _rng.integers(0, PRIME, PERMUTATIONS, dtype=np.uint64)[:, None]
_MIX = _rng.integers(0, 1 << 63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """64-bit hashes of the runs of ``size`` words, of the whole sequence if it is shorter; repeats are kept."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, text.encode("utf-8", "surrogatepass").lower().split()), np.uint64)
    width = min(size, len(own))
    if not width:
        return own
    runs = np.full(len(own) - width + 1, width, np.uint64) * _MIX[-1]
    for k in range(width):
        runs = runs + own[k : k + len(runs)] * _MIX[k]
    runs ^= runs >> np.uint64(29)
    return runs * _MIX[-1]


def signature(runs: np.ndarray) -> np.ndarray:
    """The least value of every hash function over the shingles, as 16-bit numbers; all ones without any shingle."""
    least = np.full(PERMUTATIONS, PRIME, np.uint64)
    values = runs >> np.uint64(33)
    for start in range(0, len(values), SHINGLES_AT_ONCE):
        hashed = _FACTORS * values[start : start + SHINGLES_AT_ONCE] + _SHIFTS
        hashed = (hashed & np.uint64(PRIME)) + (hashed >> np.uint64(31))
        hashed = np.minimum(hashed, hashed - np.uint64(PRIME))  # below the prime the difference wraps round to a large number
        np.minimum(least, hashed.min(1), out=least)
    return least.astype(np.uint16)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    return float((one == other).mean())


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


class Stretches:
    """Cuts of the id range, and the least id of every stretch that holds any; at most ``MOST_STRETCHES`` numbers each."""

    def __init__(self, ids: DataFrame):
        ids = ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"))
        n = ids.count()
        wanted = min(-(-n // STRETCH_ROWS), MOST_STRETCHES)
        self.cuts = np.empty(0, np.int64)
        if wanted > 1:
            every = max(1, n // (wanted * IDS_PER_CUT))
            sample = np.unique([r.doc_id for r in ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).collect()]).astype(np.int64)
            self.cuts = sample[np.unique(np.arange(1, wanted) * len(sample) // wanted)] if len(sample) else self.cuts

        def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, int] = {}
            for batch in batches:
                values = batch.column(0).to_numpy()
                places = self.place(values)
                for place in np.unique(places).tolist():
                    low = int(values[places == place].min())
                    found[place] = min(low, found.get(place, low))
            yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["stretch", "doc_id"])

        firsts = ids.mapInArrow(least, "stretch int, doc_id long").groupBy("stretch").agg(F.min("doc_id").alias("doc_id")).collect()
        firsts = sorted((r.doc_id, r.stretch) for r in firsts)
        self.firsts = np.array([f[0] for f in firsts], np.int64)
        self.before = np.array([f[1] for f in firsts[-1:] + firsts[:-1]], np.int32)  # the stretch before each

    def place(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, ids, side="right")

    def copy(self, doc_id: int) -> int | None:
        """The stretch that this document follows, if it is the first of its own."""
        at = int(np.searchsorted(self.firsts, doc_id))
        return int(self.before[at]) if at < len(self.firsts) and self.firsts[at] == doc_id else None


EDITED = (
    "doc_id long, n_chars long, edited_sha binary, signature binary, edited_signature binary, near_edited double, "
    "near_next double, digest binary"
)
RESULTS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _spelled(found: DataFrame) -> DataFrame:
    """Digest and fingerprints in hex, which takes twice the room: for results only."""
    spelled = lambda name, data: F.lower(F.hex(data)).alias(name)
    hexes = (spelled("edited_sha256", "edited_sha"), spelled("fingerprint", "signature"), spelled("edited_fingerprint", "edited_signature"))
    return found.select("*", *hexes)


def edited(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, its edited text's, their likeness to each other and to the next one's, signature and digest."""
    return _spelled(_edited(docs)).select(*RESULTS, "signature", "digest")


def _edited(docs: DataFrame) -> DataFrame:
    """Per document what ``EDITED`` names."""
    stretches = Stretches(docs.select("doc_id"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, text in zip(ids, texts, strict=True):
                text = text or ""
                digest, data = _digest(text), zipped(text)
                if doc_id is None:  # no order: any stretch of its own below zero will do
                    out.append((-1 - digest[0], 0, None, digest, data))
                    continue
                out.append((int(stretches.place(doc_id)), 0, doc_id, digest, data))
                if (stretch := stretches.copy(doc_id)) is not None:
                    out.append((stretch, 1, doc_id, digest, data))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            names = ("stretch", "extra", "doc_id", "digest", "data")
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, kinds)], names=names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.binary())
        names = [f.split()[0] for f in EDITED.split(", ")]
        out: list[tuple] = []

        def result(row, text, sign, next_text, next_sign) -> tuple:
            half = len(text) // 2
            changed = text[: len(text) - half] + next_text[:half]
            changed_sign = signature(shingles(changed))
            sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).digest()
            return (
                row[0], len(text), sha, sign.tobytes(), changed_sign.tobytes(),
                likeness(sign, changed_sign), likeness(sign, next_sign), row[1],
            )

        nothing, last = signature(shingles("")), None
        for batch in batches:
            for stretch, extra, doc_id, digest, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last and last[0] != stretch:
                    last = None
                if extra and not last:
                    continue  # a stretch's successor has been met already
                text = unzipped(data)
                sign = signature(shingles(text))
                if doc_id is None:
                    out.append(result((doc_id, digest), text, sign, "", nothing))
                    continue
                if last:
                    out.append(result(*last[1:], text, sign))
                last = None if extra else (stretch, (doc_id, digest), text, sign)
                if len(out) >= OUT_ROWS:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                    out = []
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = given.mapInArrow(deal, "stretch int, extra int, doc_id long, digest binary, data binary")
    placed = dealt.repartition("stretch").sortWithinPartitions("stretch", "extra", "doc_id", "digest")
    return placed.mapInArrow(walk, EDITED)


def bands(signed: DataFrame) -> DataFrame:
    """(token, id) for each band of each signature; the token's hash takes in the number of the band."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens = batch.column("doc_id").to_numpy(), []
            for sign in batch.column("signature").to_pylist():
                tokens += [xxhash.xxh3_64_intdigest(sign[2 * PLACES * b : 2 * PLACES * (b + 1)], seed=b) for b in range(BANDS)]
            yield pa.record_batch([pa.array(np.array(tokens, np.uint64).view(np.int64)), pa.array(np.repeat(ids, BANDS))], names=["token", "id"])

    return signed.select("doc_id", "signature").mapInArrow(cut, "token long, id long")


def _sketches(signed: DataFrame) -> DataFrame:
    """What ``minhash.linked`` compares before it reads texts: two bits of each place; eight more are the same for all. No sizes."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, PERMUTATIONS)
            bits = np.zeros((len(signs), minhash.SKETCH), np.uint64)
            bits[:, :PERMUTATIONS] = signs & np.uint16(3)
            parts = (bits.reshape(len(signs), 4, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(2, dtype=np.uint64).view(np.int64)
            sizes = pa.array(np.ones(len(signs), np.int64))
            yield pa.record_batch([batch.column("doc_id"), sizes, *(pa.array(np.ascontiguousarray(x)) for x in parts.T)], names=minhash.MEMBER)

    return signed.select("doc_id", "signature").mapInArrow(shorten, "id long, n long, s1 long, s2 long, s3 long, s4 long")


def near_texts(signed: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and class_id (least id reachable by links, itself included) of every document that has a near text.

    ``signed`` has doc_id, signature and digest. Equal texts are linked by digest, others if their shingles' Jaccard similarity is
    ``PERCENT`` or more. All texts of a repeated id count for it.
    """
    posted = signed.where("doc_id IS NOT NULL").where(F.col("signature") != F.lit(bytearray(signature(shingles("")).tobytes())))
    least = posted.groupBy("digest").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).where("head < last")
    equal = posted.select("doc_id", "digest").join(written(least.select("digest", "head"), "equal-heads"), "digest")
    copies = written(equal.where("doc_id <> head").distinct(), "copies")
    few = copies.count() <= BROADCAST_IDS
    own = posted.join(F.broadcast(copies) if few else copies, ["doc_id", "digest"], "left_anti")
    links = minhash.linked(bands(own), _sketches(own), docs, PERCENT, WORDS, LONG)
    links = links.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    return components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("class_id"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """The columns of ``edited`` but signature and digest, and class_id: the least id of the document's class of near texts."""
    signed = written(_edited(docs), "fingerprints")
    classes = written(near_texts(signed.select("doc_id", "signature", "digest"), docs), "classes")
    few = classes.count() <= BROADCAST_IDS  # 32 MB; beyond, both sides are shuffled
    joined = signed.join(F.broadcast(classes) if few else classes, "doc_id", "left")
    return _spelled(joined).select(*RESULTS, F.coalesce("class_id", "doc_id").alias("class_id"))
