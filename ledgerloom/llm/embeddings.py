"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one representative per group.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors, those with the least digests); every vector is assigned to its
nearest centroid and cells are cut into blocks of at most about ``BLOCK`` vectors. Vectors of two cells can only be
similar near the plane halfway between the centroids: if x lies on one side and y on the other, their distance is at
least the sum of their distances to the plane. A vector is therefore sent to another cell's blocks only if it is so
near that plane that the nearest vector there could be similar. This loses no pair. In data without clusters it
rules out little, and the work tends to all blocks against all blocks.

A pair of blocks gives counts of links and the connected groups inside the pair, never the pairs of vectors. Equal vectors are one vector with a weight.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.session import written

LEAST = 0.9
SAMPLE = 8192
BLOCK = 8192
CELLS = 1024
ROUNDS = 10


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def spherical_kmeans(vectors: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """Unit centroids of unit vectors; starts far apart, and an empty cell takes the worst-placed vector."""
    rng = np.random.default_rng(seed)
    centroids = vectors[[int(rng.integers(len(vectors)))]]
    nearest = vectors @ centroids[0]
    while len(centroids) < min(k, len(vectors)):
        chances = np.maximum(1 - nearest, 0) ** 2
        if chances.sum() <= 1e-12:
            break
        centroids = np.vstack([centroids, vectors[int(rng.choice(len(vectors), p=chances / chances.sum()))]])
        nearest = np.maximum(nearest, vectors @ centroids[-1])
    for _ in range(ROUNDS):
        products = vectors @ centroids.T
        cells = products.argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cells, vectors)
        lengths = np.sqrt((sums * sums).sum(1))
        for empty in np.flatnonzero(lengths < 1e-9):
            sums[empty], lengths[empty] = vectors[int(products.max(1).argmin())], 1
        centroids = sums / lengths[:, None]
    return centroids


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """Valid vectors: vec_id, digest, dim, vec (the values as bytes). Null, zero or non-finite ones are left out."""
    single = "array<float>" in dict(embeddings.dtypes)["embedding"]
    kind = np.float32 if single else np.float64

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, dims, vectors = [], [], [], []
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if values and None not in values:
                    vector = np.asarray(values, kind) + kind(0)  # -0.0 becomes 0.0
                    if np.isfinite(vector).all() and vector.any():
                        ids.append(vec_id)
                        dims.append(len(vector))
                        vectors.append(vector.tobytes())
                        digests.append(hashlib.blake2b(vectors[-1], digest_size=16).digest())
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())],
                names=["vec_id", "digest", "dim", "vec"],
            )

    cast = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = embeddings.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), cast.alias("embedding"))
    return rows.mapInArrow(keep, "vec_id long, digest binary, dim int, vec binary")


def _matrix(column: pa.ChunkedArray | pa.Array, single: bool) -> np.ndarray:
    rows = column.to_pylist()
    return unit(np.frombuffer(b"".join(rows), np.float32 if single else np.float64).reshape(len(rows), -1))


class Cells:
    """Centroids with what decides which blocks a vector meets; all of it is bounded by the number of cells."""

    def __init__(self, centroids: np.ndarray, least: float):
        self.centroids, self.reach = centroids, math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * centroids @ centroids.T))
        self.apart = np.where(apart < 1e-9, np.inf, apart)
        self.nearest = np.full((len(centroids),) * 2, np.inf)  # least distance of cell a's vectors to the plane with c
        self.first: dict[int, int] = {}
        self.chunks: dict[int, int] = {}

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors @ self.centroids.T).argmax(1)

    def margins(self, vectors: np.ndarray, cell: int) -> np.ndarray:
        """Distances to the planes halfway between this cell's centroid and each other one."""
        products = vectors @ self.centroids.T
        return (products[:, [cell]] - products) / self.apart[cell]


def _links(left: pa.Table, right: pa.Table, single: bool, least: float) -> pa.Table:
    """Links between two blocks (or inside one, if they are the same): id, weighted links, least id connected within."""
    ids = [t.column("id").to_numpy() for t in (left, right)]
    weights = [t.column("n").to_numpy().astype(np.float64) for t in (left, right)]
    a, b = (_matrix(t.column("vec"), single) for t in (left, right))
    inside = left is right
    near = np.zeros((len(a), len(b)), bool)
    for i in range(0, len(a), 512):
        near[i : i + 512] = a[i : i + 512] @ b.T >= least
    if inside:
        np.fill_diagonal(near, False)
    rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    near = near[np.ix_(rows, columns)]
    ids = [ids[0][rows], ids[1][columns]]
    counts = [np.zeros(len(rows)), np.zeros(len(columns))]
    for i in range(0, len(rows), 512):
        part = near[i : i + 512].astype(np.float64)
        counts[0][i : i + 512] = part @ weights[1][columns]
        counts[1] += weights[0][rows[i : i + 512]] @ part
    high = np.iinfo(np.int64).max
    roots, labels = np.full(len(rows), high), ids[1].copy()
    while len(rows):
        before = labels.copy()
        for i in range(0, len(rows), 512):
            roots[i : i + 512] = np.minimum(ids[0][i : i + 512], np.where(near[i : i + 512], labels[None, :], high).min(1))
        for i in range(0, len(rows), 512):
            labels = np.minimum(labels, np.where(near[i : i + 512], roots[i : i + 512, None], high).min(0))
        if (labels == before).all():
            break
    if inside:
        counts, ids, roots, labels = [counts[0]], [ids[0]], np.minimum(roots, labels), None
    return pa.table(
        {
            "id": pa.array(np.concatenate(ids), pa.int64()),
            "links": pa.array(np.concatenate(counts).astype(np.int64)),
            "root": pa.array(roots if inside else np.concatenate([roots, labels]), pa.int64()),
        }
    )


def near_duplicates(embeddings: DataFrame, least: float = LEAST, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links (other vectors with a cosine of ``least`` or more), component_id and kept; a row per input row.

    Null, empty or zero vectors and those with null or non-finite components link with nothing; neither do vectors of
    different dimension. Rows that repeat id and vector count as one. A row without ``vec_id`` links with nothing, has
    no component and is kept. Extra columns are ignored.
    """
    single = "array<float>" in dict(embeddings.dtypes)["embedding"]
    valid = written(distinct_vectors(embeddings), "vectors")
    reps = valid.groupBy("vec_id", "digest").agg(F.min("dim").alias("dim"), F.min("vec").alias("vec"))
    reps = reps.groupBy("digest").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.min("dim").alias("dim"), F.min("vec").alias("vec"))
    reps = written(reps, "distinct-vectors")
    sizes = reps.groupBy("dim").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "dim").first()
    rows, dim = (sizes.rows, sizes.dim) if sizes else (0, 0)
    chosen = reps.where(F.col("dim") == dim).orderBy("digest").limit(sample).select("vec").collect()
    seen = unit(np.frombuffer(b"".join(r.vec for r in chosen), np.float32 if single else np.float64).reshape(len(chosen), -1)) if chosen else np.ones((1, 1))
    cells = Cells(spherical_kmeans(seen, min(CELLS, 1 + rows // block)), least)
    k = len(cells.centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array(batch.column("dim").to_numpy() + k, np.int32)  # vectors of another dimension: a cell per dimension
            main = np.flatnonzero(batch.column("dim").to_numpy() == dim)
            if len(main):
                own[main] = cells.assign(_matrix(batch.column("vec").take(pa.array(main)), single))
            yield pa.record_batch([*batch.columns, pa.array(own, pa.int32())], names=[*batch.schema.names, "cell"])

    placed = written(reps.mapInArrow(assign, "digest binary, id long, n long, dim int, vec binary, cell int"), "assigned-vectors")

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.full((k, k), np.inf)
        for batch in batches:
            own = batch.column("cell").to_numpy()
            for cell in np.unique(own[own < k]).tolist():
                part = _matrix(batch.column("vec").take(pa.array(np.flatnonzero(own == cell))), single)
                low[cell] = np.minimum(low[cell], cells.margins(part, cell).min(0))
        a, c = np.nonzero(np.isfinite(low))
        yield pa.record_batch([pa.array(a, pa.int32()), pa.array(c, pa.int32()), pa.array(low[a, c])], names=["a", "c", "low"])

    for r in placed.select("cell", "vec").mapInArrow(margins, "a int, c int, low double").groupBy("a", "c").agg(F.min("low").alias("low")).collect():
        cells.nearest[r.a, r.c] = r.low
    total = 0
    for r in sorted(placed.groupBy("cell").agg(F.count("*").alias("rows")).collect()):  # a row per cell
        cells.first[r.cell], cells.chunks[r.cell] = total, -(-r.rows // block)
        total += cells.chunks[r.cell]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("cell").to_numpy()
            salts = np.frombuffer(b"".join(d[:4] for d in batch.column("digest").to_pylist()), "<u4").astype(np.int64)
            slim = batch.select(["id", "n", "vec"])
            for cell in np.unique(own).tolist():
                at = np.flatnonzero(own == cell)
                mine = cells.first[cell] + salts[at] % cells.chunks[cell]
                others = {cell: np.ones(len(at), bool)}
                if cell < k:
                    distance = cells.margins(_matrix(batch.column("vec").take(pa.array(at)), single), cell)
                    for c in cells.first:
                        if c < k and c != cell:
                            close = distance[:, c] <= cells.reach - cells.nearest[c, cell]
                            if close.any():
                                others[c] = close
                for c, close in others.items():
                    for chunk in range(cells.chunks[c]):
                        other = cells.first[c] + chunk
                        use = np.flatnonzero(close)
                        part = slim.take(pa.array(at[use]))
                        blocks = np.stack([mine[use], np.full(len(use), other)])
                        yield pa.record_batch(
                            [pa.array(blocks.min(0)), pa.array(blocks.max(0)), pa.array(mine[use]), *part.columns], names=["low", "high", "own", "id", "n", "vec"]
                        )

    def compare(group: pa.Table) -> pa.Table:
        own, low, high = (group.column(c).to_numpy() for c in ("own", "low", "high"))
        left = group.filter(pa.array(own == low))
        right = left if low[0] == high[0] else group.filter(pa.array(own == high))
        if not left.num_rows or not right.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        return _links(left, right, single, least)

    met = placed.mapInArrow(meet, "low long, high long, own long, id long, n long, vec binary")
    links = written(met.groupBy("low", "high").applyInArrow(compare, "id long, links long, root long"), "links")
    linked = links.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    final = (
        reps.select("digest", "id", "n").join(linked, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    by_id = valid.select("vec_id", "digest").distinct().join(final, "digest").groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).join(by_id, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
