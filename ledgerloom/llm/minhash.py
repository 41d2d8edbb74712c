"""MinHash near-dedup by a signature-coordinate inverted join.

A document's signature has ``COORDS`` minima of its shingle set. Each document is posted under its coordinate-value
pairs. Documents as similar as the threshold agree in at least ``MATCHES`` coordinates (fewer has a probability of
about one in a million), so it is enough to post each under its ``COORDS - MATCHES + 1`` rarest pairs: two documents
that agree often enough share one of those. That prefix skips the long lists of common pairs.

Only connections are asked for, so a list is not expanded into all its pairs. First every member of a list meets the
list's least document. Then the lists are looked at again by component: documents outside a list's largest component
meet one member of it, another one in every list. At last those that are still outside meet all others of the list that
they are not connected with; in long lists block by block, where a pair is compared in one list only, skipped once its
components have met, and only links come out. So each pair that shares a list is either compared or already connected. Pairs are
compared on full shingle sets if their sketches, two bits of each of ``SKETCH`` further coordinates, agree as often as
similar documents do. Equal shingle sets are one representative all along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.texts import hold_only, texts_of, unzipped
from ledgerloom.session import written

COORDS = 32
MATCHES = 14
PREFIX = COORDS - MATCHES + 1
SKETCH = 128  # coordinates in the sketch, two bits of each
AGREEING = 88  # of them; a pair at the threshold agrees in 109, with a deviation of 4
PERCENT = 80
SHINGLE = 2
BUCKETS = 1 << 18  # of the table of pair frequencies, which is collected
SHARED_BITS = 1 << 22  # of the filter that keeps values of a single document out of the second shuffle
LONG = 10_000  # pairs that the documents outside a list's largest component may make before it is compared in blocks
BLOCK = 512
WORDS_HELD = 200_000

_ODD = (np.random.default_rng(7).integers(1, 2**63, SKETCH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = np.random.default_rng(8).integers(1, 2**63, SKETCH, dtype=np.uint64)
_K = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a text with fewer words has its whole sequence as one."""
    words = (text or "").encode().lower().split()  # bytes: ASCII white space, A-Z only
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mixed(out * _K + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least permuted value in each coordinate."""
    least = np.full(SKETCH, 2**64 - 1, np.uint64)
    for start in range(0, len(hashes), 512):
        part = hashes[start : start + 512]
        least = np.minimum(least, (part[None, :] * _ODD[:, None] + _ADD[:, None]).min(1))
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketch(signature: np.ndarray) -> np.ndarray:
    """Two bits of every coordinate, in four 64-bit numbers."""
    bits = _mixed(signature.astype(np.uint64) * _K) & np.uint64(3)
    return (bits.reshape(4, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(1, dtype=np.uint64).view(np.int64)


def _agreeing(a: Column, b: Column) -> Column:
    """Equal two-bit groups of two 64-bit numbers."""
    x = a.bitwiseXOR(b)
    return F.lit(32) - F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the shingle set), signature (its first ``COORDS`` coordinates) and sketch; null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only(_WORDS)
        for batch in batches:
            counts, ids, signed, sketches = [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text, size)
                counts.append(len(own))
                ids.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                least = signature(own) if len(own) else None
                signed.append(least[:COORDS].tobytes() if len(own) else None)
                sketches.append(_sketch(least).tobytes() if len(own) else None)
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), *(pa.array(c, pa.binary()) for c in (ids, signed, sketches))],
                names=["doc_id", "n_shingles", "set_id", "signature", "sketch"],
            )

    kinds = "doc_id long, n_shingles long, set_id binary, signature binary, sketch binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, kinds)


def _pairs_of(signed: np.ndarray) -> np.ndarray:
    """Coordinate-value pairs as numbers."""
    return (signed.astype(np.int64) << 8) | np.arange(COORDS, dtype=np.int64)[None, :]


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (_mixed(tokens.astype(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDS)


def postings(reps: DataFrame) -> DataFrame:
    """Each representative under its rarest pairs: token and id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            if batch.num_rows:
                totals += np.bincount(_bucket(_pairs_of(_matrix(batch.column(0)))).ravel(), minlength=BUCKETS)
        used = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(totals[used])], names=["bucket", "n"])

    rows = reps.select("signature").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    often = np.zeros(BUCKETS, np.int64)
    for r in rows:
        often[r.bucket] = r.n

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signed = _matrix(batch.column("signature"))
            tokens = _pairs_of(signed)
            order = np.lexsort((tokens, often[_bucket(tokens)]), axis=1)[:, :PREFIX]
            ids = np.repeat(batch.column("id").to_numpy(), PREFIX)
            yield pa.record_batch([pa.array(_mixed(np.take_along_axis(tokens, order, 1).ravel().view(np.uint64)).view(np.int64)), pa.array(ids)], names=["token", "id"])

    return reps.select("id", "signature").mapInArrow(post, "token long, id long")


def sketches(reps: DataFrame) -> DataFrame:
    """id, n and the sketch s1 to s4 as numbers."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.int64).reshape(-1, 4)
            yield pa.record_batch([batch.column("id"), batch.column("n"), *(pa.array(x) for x in parts.T)], names=MEMBER)

    return reps.select("id", "n", "sketch").mapInArrow(spread, "id long, n long, s1 long, s2 long, s3 long, s4 long")


MEMBER = ["id", "n", "s1", "s2", "s3", "s4"]


def _alike(a: str, b: str, percent: int) -> Column:
    """Sizes that allow the similarity, and sketches that agree often enough."""
    sizes = (F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent)
    return sizes & (sum(_agreeing(F.col(f"{a}.{s}"), F.col(f"{b}.{s}")) for s in MEMBER[2:]) >= AGREEING)


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(f"{a}.id", f"{b}.id").alias("a"), F.greatest(f"{a}.id", f"{b}.id").alias("b")]


def _possible(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow."""
    side = lambda name: members.select(F.col("id").alias(name), F.struct(*MEMBER[1:]).alias(f"{name}_m"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_alike("a_m", "b_m", percent)).select("a", "b").distinct()


def _open_lists(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the lists that hold several components, with their ``component`` and the list's largest one, ``main``."""
    label = F.coalesce("component", "id").alias("component")
    labelled = shared.join(found, shared["id"] == found["node"], "left").select("token", "id", label)
    by_part = labelled.groupBy("token", "component").agg(F.count("*").alias("members"))
    several = by_part.groupBy("token").agg(F.max_by("component", F.struct("members", "component")).alias("main"), F.count("*").alias("parts"))
    return labelled.join(several.where("parts > 1").select("token", "main"), "token")


def _shared(posted: DataFrame) -> DataFrame:
    """token, id and head (the least id) of the lists with several ids.

    A bit for every value that is shared, at most ``SHARED_BITS`` whatever their count, keeps most single ones out of the second shuffle.
    """
    heads = posted.groupBy("token").agg(F.min("id").alias("head"), F.max("id").alias("last")).where("head < last")
    heads = written(heads.select("token", "head"), "heads")
    rows = heads.select(F.col("token").bitwiseAND(F.lit(SHARED_BITS - 1)).cast("int").alias("bit")).distinct().toArrow()
    held = np.zeros(SHARED_BITS, bool)
    held[rows.column("bit").to_numpy()] = True

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held[batch.column("token").to_numpy() & (SHARED_BITS - 1)]))

    return written(posted.mapInArrow(keep, "token long, id long").join(heads, "token"), "shared-lists")


def _compared(pairs: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    texts = texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    first = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("data").alias("text_a")), "a")
    both = first.join(texts.select(F.col("doc_id").alias("b"), F.col("data").alias("text_b")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only(_WORDS)
        for batch in batches:
            left, right, held = [], [], {}
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) > 64:
                    held.clear()
                sets = []
                for text in (text_a, text_b):
                    if text not in held:
                        held[text] = shingles(unzipped(text), size)
                    sets.append(held[text])
                common = len(np.intersect1d(*sets, assume_unique=True))
                if 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common):
                    left.append(a)
                    right.append(b)
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long").distinct()


def _compared_in_blocks(lists: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Links (a, b) between documents outside a long list's largest component and all others of the list.

    A list's outsiders and members are cut into blocks, and each pair of blocks is a group of at most about
    ``2 * BLOCK`` rows with their texts. A pair that shares several long lists is compared in that of the least token.
    """
    out_blocks, all_blocks = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("out", "k"))
    own_out = F.pmod(F.xxhash64("id", F.lit(1)), out_blocks).cast("int")
    own_all = F.pmod(F.xxhash64("id"), all_blocks).cast("int")
    tokens = lists.groupBy("id").agg(F.collect_set("token").alias("tokens"))  # as few as an id is posted under
    columns = ["token", *MEMBER, "component"]
    outside = lists.where("component <> main").select(*columns, F.lit(0).alias("side"), own_out.alias("ob"), F.explode(F.sequence(F.lit(0), all_blocks - 1)).alias("mb"))
    members = lists.select(*columns, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), out_blocks - 1)).alias("ob"), own_all.alias("mb"))
    texts = texts_of(docs, tokens.select(F.col("id").alias("doc_id"))).select(F.col("doc_id").alias("id"), "data").join(tokens, "id")
    dealt = outside.unionByName(members).join(texts, "id")

    def compare(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        rows = [group.filter(pa.array(side == k)) for k in (0, 1)]
        left, right, texts_a, texts_b = [], [], *(t.column("data").to_pylist() for t in rows)
        if rows[0].num_rows and rows[1].num_rows:
            token = group.column("token")[0].as_py()
            (ids_a, n_a, part_a), (ids_b, n_b, part_b) = ([t.column(c).to_numpy() for c in ("id", "n", "component")] for t in rows)
            sketch_a, sketch_b = (np.stack([t.column(s).to_numpy() for s in MEMBER[2:]], 1).view(np.uint64) for t in rows)
            tokens_b = rows[1].column("tokens").to_pylist()
            shared = np.full((len(ids_b), max(map(len, tokens_b))), -1, np.int64)
            for i, own in enumerate(tokens_b):
                shared[i, : len(own)] = own
            roots: dict[int, int] = {}
            sets: dict[int, np.ndarray] = {}

            def root(component: int) -> int:
                while (up := roots.get(component, component)) != component:
                    component = up
                return component

            for i, own in enumerate(rows[0].column("tokens").to_pylist()):
                x = sketch_b ^ sketch_a[i]
                agree = 32 * x.shape[1] - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(1, dtype=np.int64)
                common = np.where(np.isin(shared, own), shared, np.iinfo(np.int64).max).min(1)
                sizes = np.minimum(n_b, n_a[i]) * 100 >= np.maximum(n_b, n_a[i]) * percent
                mine = shingles(unzipped(texts_a[i]), size)
                for j in np.flatnonzero((agree >= AGREEING) & sizes & (common == token) & (part_b != part_a[i])).tolist():
                    a, b = root(int(part_a[i])), root(int(part_b[j]))
                    if a == b:
                        continue
                    if j not in sets:
                        sets[j] = shingles(unzipped(texts_b[j]), size)
                    both = len(np.intersect1d(mine, sets[j], assume_unique=True))
                    if 100 * both >= percent * (len(mine) + len(sets[j]) - both):
                        roots[a] = b
                        left.append(ids_a[i])
                        right.append(ids_b[j])
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return dealt.groupBy("token", "ob", "mb").applyInArrow(compare, "a long, b long")


def linked(posted: DataFrame, members: DataFrame, docs: DataFrame, percent: int, size: int, long: int = LONG) -> DataFrame:
    """Links (a, b) that connect whatever is similar enough among ids that share a list of ``posted`` (token, id).

    ``members`` has the ids with the columns of ``MEMBER``. Lists carry ids alone; sketches come to pairs, or to lists that are still open.
    A list whose outsiders make more than ``long`` pairs is compared in blocks.
    """
    shared = _shared(written(posted, "postings"))  # filtered by another worker than the one that posts: never both beside the heap
    members = written(members, "members")
    met = shared.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    first = written(_possible(met, members, percent), "first-pairs")
    links = written(_compared(first, docs, percent, size), "first-links")
    shared = shared.select("token", "id")

    lists = written(_open_lists(shared, components(links)), "open-lists")
    inside = lists.where("component = main").groupBy("token").agg(F.min_by("id", F.xxhash64("id", "token")).alias("p"))
    outside = lists.where("component <> main").join(inside, "token")
    second = outside.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct()
    second = written(_possible(second.join(first, ["a", "b"], "left_anti"), members, percent), "second-pairs")
    links = written(links.unionByName(_compared(second, docs, percent, size)), "second-links")

    lists = _open_lists(lists.select("token", "id"), components(links))  # a list whose members have met stays closed
    lists = written(lists.join(members, "id").select("token", *MEMBER, "component", "main"), "still-open-lists")
    sizes = lists.groupBy("token").agg(F.count("*").alias("k"), F.count_if(F.col("component") != F.col("main")).alias("out"))
    sizes = written(sizes.where(F.col("k") * F.col("out") > long), "long-lists")
    in_blocks = _compared_in_blocks(lists.join(sizes, "token"), docs, percent, size)
    lists = lists.join(sizes, "token", "left_anti")
    rest = (
        lists.where("component <> main").alias("o").join(lists.alias("m"), F.col("o.token") == F.col("m.token"))
        .where((F.col("o.component") != F.col("m.component")) & _alike("o", "m", percent))
        .where((F.col("m.component") == F.col("m.main")) | (F.col("o.id") < F.col("m.id")))
        .select(*_pair("o", "m")).distinct()
    )
    rest = written(rest.join(first.unionByName(second), ["a", "b"], "left_anti"), "last-pairs")
    return written(links.unionByName(_compared(rest, docs, percent, size)).unionByName(in_blocks), "last-links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) and kept; a row per input row.

    Documents without words are linked with nothing. A row without ``doc_id`` is linked with nothing and kept, its
    component is null. Rows that repeat an id and a text get equal results. Extra columns are ignored.
    """
    signed = written(signatures(docs, size), "signatures")
    reps = written(
        signed.where("doc_id IS NOT NULL AND set_id IS NOT NULL").groupBy("set_id")
        .agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("n"), F.min("signature").alias("signature"), F.min("sketch").alias("sketch")), "representatives",
    )
    least = -(-percent // max(1, 100 - percent))  # smaller sets are similar to equal ones only
    several = reps.where(F.col("n") >= least)
    found = components(linked(postings(several), sketches(several), docs, percent, size))

    final = reps.select("set_id", "id").join(found, F.col("id") == F.col("node"), "left").select("set_id", F.coalesce("component", "id").alias("component"))
    return signed.join(final, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.col("doc_id") == F.coalesce("component", "doc_id")).otherwise(True).alias("kept"),
    )
