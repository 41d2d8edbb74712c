"""Hard-negative mining by Fagin's threshold algorithm over blocks of candidates.

All anchors are set against all rows, block by block. A block holds its rows in one sorted list per dimension. An anchor reads the
lists in step, from the end that its own component's sign makes the better one; what it meets is scored whole (integer inner
product), and no unseen row can score more than the anchor's product with the values last read, the threshold. Reading stops once
the threshold is strictly below the score of the last wanted row, so ties are read to their end. A first pass finds each anchor's
positives (lists of its label only), a second one the negatives of all windows that its positives set, with one reading for all of them. Blocks give their
best few rows per anchor or window; the best of all blocks are ranked after a shuffle in which each task keeps only those few.

Rows with a null id, a null label, a null or empty vector, or a component that is null, not finite or not finite times 256 take no
part. Of rows that repeat an id the one with the least label, then the least vector, counts. Vectors of different lengths are
not compared. Scores are exact at any size; one that does not fit a long is returned as null, after it was ranked. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.operators.dedup import first_per_key
from ledgerloom.session import written

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LEAST_SHARE, MOST_SHARE = 30, 90  # percent of the positive's score
BLOCK = 16384  # rows
CHUNK = 1024  # anchors that meet a block together
DEPTH = 16  # of the first reading; each further one goes twice as deep
EXACT, SINGLE = 2.0**53, 2.0**24  # below these, whole numbers and their sums are exact in double and single precision
LONG = 1 << 63


class Lists:
    """Rows of one block with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.most = ids, float(np.abs(rows).max(initial=0))
        small = rows.shape[1] * self.most * self.most < SINGLE
        self.rows = rows.astype(np.float32) if small else rows
        self.order = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T.astype(np.int32))  # row places, least value first

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, object]]:
        """Readings of growing depth: places met for the first time, their scores, and the threshold for all others (None: there are none)."""
        n, up, down = len(self.rows), np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        largest = len(anchor) * self.most * float(np.abs(anchor).max(initial=0))
        score = _products if largest < EXACT else _long_products
        if largest < SINGLE:
            anchor = anchor.astype(self.rows.dtype)
        used = np.concatenate([up, down])
        if not len(used):
            yield np.arange(n), score(self.rows, anchor), None
            return
        met, left, start, depth = np.zeros(n, bool), n, 0, DEPTH
        while left:
            end = min(depth, n)
            now = np.zeros(n, bool)
            now[self.order[up, n - end : n - start]] = True  # the better end of a list is the one of the component's sign
            now[self.order[down, start:end]] = True
            fresh = np.flatnonzero(now & ~met)
            met |= now
            left -= len(fresh)
            last = self.rows[np.concatenate([self.order[up, n - end], self.order[down, end - 1]]), used]
            threshold = score(last[None], anchor[used])[0] if left else None
            yield fresh, score(self.rows[fresh], anchor), threshold
            start, depth = end, depth * 2


def _products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products in floating point; the caller has seen that they are exact."""
    return rows @ anchor


def _long_products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """The same in whole numbers of any size, for components that are too large for doubles."""
    whole = np.frompyfunc(int, 1, 1)
    return whole(rows).dot(whole(anchor)) if len(rows) else np.empty(0, object)


class Best:
    """The first ``k`` rows by score, then by least id, among those offered."""

    def __init__(self, k: int, least: int | None = None, most: int | None = None):
        self.k, self.least, self.most = k, least, most
        self.rows: list[tuple[int, int]] = []  # (minus score, id), in order

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.least is not None:
            inside = (scores >= self.least) & (scores <= self.most)
            ids, scores = ids[inside], scores[inside]
        if len(self.rows) == self.k:
            good = scores >= -self.rows[-1][0]
            ids, scores = ids[good], scores[good]
        if len(ids) > self.k:  # all that tie with the k-th score stay for the ids to decide
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k] if scores.dtype != object else sorted(scores)[-self.k]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        if len(ids):
            self.rows = sorted(self.rows + [(-int(s), int(i)) for i, s in zip(ids, scores)])[: self.k]

    def done(self, threshold) -> bool:
        """No row that scores the threshold or less can come in any more."""
        if self.least is not None and threshold < self.least:
            return True
        return len(self.rows) == self.k and threshold < -self.rows[-1][0]


def mine(lists: Lists, anchor: np.ndarray, allowed: np.ndarray, wanted: list[Best]) -> None:
    """Fill the wanted bests from one reading of the lists; only ``allowed`` places take part."""
    open_ = list(wanted)
    for places, scores, threshold in lists.read(anchor):
        good = allowed[places]
        for best in open_:
            best.offer(lists.ids[places[good]], scores[good])
        if threshold is not None:
            open_ = [best for best in open_ if not best.done(threshold)]
            if not open_:
                return


def valid_rows(embeddings: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, dim, vec (floor(256 x) as bytes), one row per id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, dims, vectors = [], [], [], []
            for vec_id, own, values in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if not values or None in values:
                    continue
                with np.errstate(over="ignore"):
                    scaled = np.asarray(values, np.float64) * SCALE
                if np.isfinite(scaled).all():
                    ids.append(vec_id)
                    labels.append(own)
                    dims.append(len(values))
                    vectors.append((np.floor(scaled) + 0.0).tobytes())
            columns = [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())]
            yield pa.record_batch(columns, names=["vec_id", "label", "dim", "vec"])

    given = embeddings.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>"))
    packed = given.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").mapInArrow(pack, "vec_id long, label long, dim int, vec binary")
    return first_per_key(packed, ["vec_id"], "label", "vec")


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    rows = vectors.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _against_blocks(anchors: DataFrame, rows: DataFrame, n_rows: int, n_anchors: int, search, result: str) -> DataFrame:
    """Every chunk of anchors with every block of rows of its dimension, as one group each."""
    blocks, chunks = -(-n_rows // BLOCK) or 1, -(-n_anchors // CHUNK) or 1
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("chunk", part(chunks)).withColumn("block", each(blocks))
    right = rows.withColumn("block", part(blocks)).withColumn("chunk", each(chunks))
    left = left.select(*[F.col(c).alias(f"a_{c}") for c in left.columns])  # anchors are rows too: names and columns of their own
    keys = ("dim", "chunk", "block")
    return left.groupBy(*[f"a_{k}" for k in keys]).cogroup(right.groupBy(*keys)).applyInArrow(search, result)


def positives(anchors: DataFrame, rows: DataFrame, n_rows: int, n_anchors: int, k: int) -> DataFrame:
    """anchor_id, positive_id, score (decimal text): the first ``k`` other rows of each anchor's label."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, str]] = []
        if left.num_rows and right.num_rows:
            queries, ids, labels, matrix = _matrix(left.column("a_vec")), right.column("vec_id").to_numpy(), right.column("label").to_numpy(), _matrix(right.column("vec"))
            own = left.column("a_label").to_numpy()
            for label in np.unique(own):
                inside = labels == label
                if inside.any():
                    lists = Lists(ids[inside], matrix[inside])
                    for q in np.flatnonzero(own == label):
                        anchor_id, best = left.column("a_vec_id")[q].as_py(), Best(k)
                        mine(lists, queries[q], lists.ids != anchor_id, [best])
                        found += [(anchor_id, i, str(-minus)) for minus, i in best.rows]
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({"anchor_id": pa.array(columns[0], pa.int64()), "positive_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.string())})

    near = _against_blocks(anchors, rows, n_rows, n_anchors, search, "anchor_id long, positive_id long, score string")
    return _first(near, ["anchor_id"], "score", "positive_id", k).drop("rank")


def _order(score: str) -> list[Column]:
    """Whole numbers of any length, written as text, greatest first."""
    negative, size = F.col(score).startswith("-"), F.length(score)
    return [negative.asc(), F.when(negative, size).otherwise(-size).asc(), F.when(~negative, F.col(score)).desc(), F.when(negative, F.col(score)).asc()]


def _first(df: DataFrame, keys: list[str], score: str, other: str, k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*_order(score), F.col(other).asc())
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def negatives(anchors: DataFrame, rows: DataFrame, n_rows: int, n_anchors: int, least: int, most: int, k: int) -> DataFrame:
    """anchor_id, positive_id, positive_score, negative_id, score: the first ``k`` rows of other labels in each positive's window.

    ``anchors`` carry ``found``: at most as many (positive_id, score) as there are positives.
    """

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, str, int, str]] = []
        if left.num_rows and right.num_rows:
            queries, labels = _matrix(left.column("a_vec")), right.column("label").to_numpy()
            lists = Lists(right.column("vec_id").to_numpy(), _matrix(right.column("vec")))
            for q in range(left.num_rows):
                anchor_id, windows = left.column("a_vec_id")[q].as_py(), []
                for positive in left.column("a_found")[q].as_py():
                    score = int(positive["score"])
                    low, high = -(-least * score // 100), most * score // 100
                    if low <= high:
                        windows.append((positive, Best(k, low, high)))
                if windows:
                    mine(lists, queries[q], labels != left.column("a_label")[q].as_py(), [best for _, best in windows])
                    out += [(anchor_id, p["positive_id"], p["score"], i, str(-minus)) for p, best in windows for minus, i in best.rows]
        columns = list(zip(*out)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "score")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

    schema = "anchor_id long, positive_id long, positive_score string, negative_id long, score string"
    return _first(_against_blocks(anchors, rows, n_rows, n_anchors, search, schema), ["anchor_id", "positive_id"], "score", "negative_id", k)


def hard_negatives(
    embeddings: DataFrame,
    label: Column | None = None,
    anchor: Column | None = None,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    least: int = LEAST_SHARE,
    most: int = MOST_SHARE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every anchor (a condition on ``vec_id``).

    A negative's score lies between ``least`` and ``most`` percent of the positive's; a positive below zero has no window.
    """
    label = F.col("label") if label is None else label
    anchor = F.col("vec_id") % ANCHOR_EVERY == 0 if anchor is None else anchor
    rows = written(valid_rows(embeddings, label), "vectors")
    queries = rows.where(anchor)
    n_rows, n_anchors = rows.count(), queries.count()
    near = positives(queries, rows, n_rows, n_anchors, n_positives)
    found = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("found"))  # n_positives at most
    armed = written(queries.join(found, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "anchors")
    mined = negatives(armed, rows, n_rows, n_anchors, least, most, n_negatives)
    whole = lambda c: F.col(c).try_cast("long")
    return mined.select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id",
        whole("positive_score").alias("positive_score"), whole("score").alias("negative_score"),
    )
