"""Removal of repeated byte passages by a hash-compared suffix sort.

A byte goes if a ``SPAN``-byte string that covers it also starts earlier (in a smaller doc_id, or before it in the same
document). Every ``SPAN``-byte window has an anchor, the least-hashed gram of ``GRAM`` bytes in it; equal windows
have equal anchors at equal offsets. So windows are compared only where anchors recur, in three steps:

1. Each run of windows with one anchor is a row. Rows with the same anchor and the same bytes around it are copies:
   all but the earliest lose their windows at once. Copies met in one batch never leave their task, so a passage that
   many documents share is a few rows per task.
2. The earliest rows of anchors with several different surroundings have their bytes fetched (a window belongs to the
   left or the right part of its row, whose key is ``2 / 3`` of the window at least; this splits frequent anchors).
   Of an anchor with more than ``MANY`` surroundings, the windows go on as digests, one by one.
3. The window starts of a part are sorted as suffixes: a merge sort whose comparisons find the common extension
   by binary search over prefix polynomial hashes. Neighbours that agree over the whole window are verified byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import written

SPAN = 100
GRAM = 28
SIDE = 38  # a window that starts at least so far left of its anchor belongs to the left part
SEGMENT = 1 << 20
PRINT_BITS = 20  # of the text's hash in a position, to tell rows apart that repeat a doc_id
STARTS = 1 << 18  # window starts sorted at once
MANY = 20_000  # different surroundings of one anchor beyond which its windows are told apart by digests
NO_ID = -(1 << 63)

_BYTE = np.random.default_rng(17).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_M = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_INDEX = np.uint64((1 << 24) - 1)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = a * _M + b
    return mixed ^ (mixed >> np.uint64(29))


def _grams(values: np.ndarray) -> np.ndarray:
    """A hash for every gram of ``GRAM`` bytes, by doubling."""
    done, have, size = None, values, 1
    got, bits = 0, GRAM
    while bits:
        if bits & 1:
            shifted = have[got : len(have)]
            done = shifted if done is None else _join(done[: len(shifted)], shifted[: len(done)])
            got += size
        bits >>= 1
        if bits:
            have, size = _join(have[:-size], have[size:]), size * 2
    return done[: len(values) - GRAM + 1]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        values, done = np.minimum(values[:-step], values[step:]), done + step
    return values


def anchors(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor: first start, last start, anchor position, anchor hash."""
    for at in range(0, len(data) - SPAN + 1, SEGMENT):
        part = np.frombuffer(data, np.uint8, min(SEGMENT + SPAN - 1, len(data) - at), at)
        grams = _grams(_BYTE[part])
        mixed = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
        keys = (mixed & ~_INDEX) | np.arange(len(mixed), dtype=np.uint64)
        place = (_least(keys, SPAN - GRAM + 1) & _INDEX).astype(np.int64)
        last = np.r_[np.flatnonzero(np.diff(place)), len(place) - 1]
        first = np.r_[0, last[:-1] + 1]
        yield first + at, last + at, place[last] + at, (mixed ^ (mixed >> np.uint64(33)))[place[last]].view(np.int64)


def _rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch's runs. One row per set of copies goes on; the windows of the others are repeats (shape -1, last start in ``around``)."""
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    for doc, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        data = text.encode()
        for first, last, place, anchor in anchors(data):
            around = np.fromiter(
                (xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(first.tolist(), (last + SPAN).tolist(), strict=True)), np.uint64, len(first)
            ).view(np.int64)
            shape = ((place - first) << 8) | (last - first)
            for to, values in zip(columns, (anchor, around, np.full(len(first), doc), (first << PRINT_BITS) | mark, shape), strict=True):
                to.append(values)
    if not columns[0]:
        return pa.record_batch([pa.array([], pa.int64())] * 5, names=NAMES)
    anchor, around, docs, pos, shape = (np.concatenate(c) for c in columns)
    order = np.lexsort((pos, docs, shape, around, anchor))
    anchor, around, docs, pos, shape = (x[order] for x in (anchor, around, docs, pos, shape))
    leads = np.r_[True, (anchor[1:] != anchor[:-1]) | (around[1:] != around[:-1]) | (shape[1:] != shape[:-1])]
    lead = np.maximum.accumulate(np.where(leads, np.arange(len(leads)), 0))
    copies = (docs != docs[lead]) | (pos != pos[lead])
    # windows of copies: neighbouring runs of a document become one repeat
    some = np.flatnonzero(copies)
    some = some[np.lexsort((pos[some], pos[some] & ((1 << PRINT_BITS) - 1), docs[some]))]
    low, high = pos[some] >> PRINT_BITS, (pos[some] >> PRINT_BITS) + (shape[some] & 255)
    mark = pos[some] & ((1 << PRINT_BITS) - 1)
    starts = np.r_[True, (docs[some][1:] != docs[some][:-1]) | (mark[1:] != mark[:-1]) | (low[1:] > high[:-1] + 1)][: len(some)]
    begin = np.flatnonzero(starts)
    end = np.r_[begin[1:] - 1, len(some) - 1][: len(begin)]
    kept = np.flatnonzero(leads)
    out = (
        np.concatenate([anchor[kept], anchor[some[begin]]]),
        np.concatenate([around[kept], high[end]]),
        np.concatenate([docs[kept], docs[some[begin]]]),
        np.concatenate([pos[kept], pos[some[begin]]]),
        np.concatenate([shape[kept], np.full(len(begin), -1)]),
    )
    return pa.record_batch([pa.array(x) for x in out], names=NAMES)


NAMES = ["anchor", "around", "doc", "pos", "shape"]
ROW = "anchor long, around long, doc long, pos long, shape long"


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by anchor, shape and surroundings: repeats (shape -1), and the rows whose windows need a comparison.

    Between batches only the current class's first row is held, and the current anchor's until a second class shows.
    """
    prior = None  # first row of the current class
    pending = None  # only class of the current anchor so far
    for batch in batches:
        columns = np.stack([c.to_numpy() for c in batch.columns])
        out = [columns[:, columns[4] < 0]]
        rows = columns[:, columns[4] >= 0]
        if rows.shape[1]:
            full = rows if prior is None else np.concatenate([prior, rows], 1)
            leads = np.r_[True, (full[[0, 1, 4], 1:] != full[[0, 1, 4], :-1]).any(0)]
            lead = np.maximum.accumulate(np.where(leads, np.arange(len(leads)), 0))
            copies = full[:, (full[2] != full[2, lead]) | (full[3] != full[3, lead])]
            out.append(np.stack([copies[0], (copies[3] >> PRINT_BITS) + (copies[4] & 255), copies[2], copies[3], np.full(copies.shape[1], -1)]))
            firsts = full[:, leads]
            if firsts.shape[1] > 1 or prior is None:
                same = firsts[0, 1:] == firsts[0, :-1]
                several = np.r_[same, False] | np.r_[False, same]
                if prior is not None:  # its class was met before
                    if pending is not None and several[0]:
                        out.append(pending)
                    elif pending is None:
                        several[firsts[0] == firsts[0, 0]] = True
                    out.append(firsts[:, 1:][:, several[1:]])
                else:
                    out.append(firsts[:, several])
                pending = None if several[-1] else firsts[:, [-1]]
            prior = full[:, [lead[-1]]]
        yield pa.record_batch([pa.array(x) for x in np.concatenate(out, 1)], names=NAMES)


PART = "key long, doc long, pos long, back long, starts long, bytes binary"
PART_NAMES = ["key", "doc", "pos", "back", "starts", "bytes"]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row to compare, the bytes of its left and right windows. ``back`` is how far the first start lies before the anchor."""
    for batch in batches:
        rows = []
        for doc, mark, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            for want in wanted:
                first, back, more = want["pos"] >> PRINT_BITS, want["shape"] >> 8, want["shape"] & 255
                place, last = first + back, first + more
                if want["many"]:
                    for start in range(first, last + 1):
                        one, two = np.frombuffer(xxhash.xxh3_128_digest(data[start : start + SPAN]), np.uint64)
                        rows.append((one, doc, start << PRINT_BITS | mark, two.view(np.int64), -1, None))
                    continue
                split = place - SIDE  # the last start of the left part
                if first <= split:
                    end = min(last, split)
                    key = xxhash.xxh3_64_intdigest(data[place - SIDE : place + GRAM], 1)
                    rows.append((key, doc, first << PRINT_BITS | mark, back, end - first + 1, data[first : end + SPAN]))
                if last > split:
                    start = max(first, split + 1)
                    key = xxhash.xxh3_64_intdigest(data[place : place + SPAN - SIDE + 1], 2)
                    rows.append((key, doc, start << PRINT_BITS | mark, place - start, last - start + 1, data[start : last + SPAN]))
        if rows:
            columns = list(zip(*rows, strict=True))
            keys = np.array(columns[0], np.uint64).view(np.int64)
            yield pa.record_batch([pa.array(keys), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(columns[5], pa.binary())], names=PART_NAMES)


class Suffixes:
    """Suffixes of one buffer, compared over ``SPAN`` bytes by prefix polynomial hashes (modulo 2^64)."""

    def __init__(self, buffer: bytes):
        self.bytes = np.frombuffer(buffer, np.uint8)
        n = len(self.bytes)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        self.powers = np.cumprod(powers, dtype=np.uint64)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.bytes] * self.powers[:n], dtype=np.uint64, out=self.prefix[1:])

    def _hash(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.powers[len(self.bytes) - at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes have in common, up to ``SPAN``."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), SPAN, np.int64)
        for _ in range(int(SPAN).bit_length()):
            middle = (low + high + 1) // 2
            equal = self._hash(a, middle) == self._hash(b, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, np.maximum(low, middle - 1))
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        same = self.common(a, b)
        step = np.minimum(same, SPAN - 1)
        return np.where(same == SPAN, or_equal, self.bytes[a + step] < self.bytes[b + step])

    def sort(self, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """An order that sorts the suffixes within each bucket; ``bucket`` is ascending. Bottom-up merge sort, all merges of a round at once."""
        n = len(starts)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[first, n])
        base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        order, run = np.arange(n), 1
        while n and run < sizes.max():
            active = np.flatnonzero(size > run)  # positions in buckets that still have several runs
            inside = active - base[active]
            right = (inside // run) % 2 == 1
            pair = inside // (2 * run) * (2 * run)
            other = np.where(right, pair, pair + run)
            low = np.zeros(len(active), np.int64)
            high = np.clip(size[active] - other, 0, run)
            mine = starts[order[active]]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                theirs = starts[order[base[active[open_]] + other[open_] + middle]]
                before = self.less(theirs, mine[open_], right[open_])  # ties: the left run comes first
                low[open_], high[open_] = np.where(before, middle + 1, low[open_]), np.where(before, high[open_], middle)
            target = base[active] + pair + inside % run + low
            merged = order.copy()
            merged[target] = order[active]
            order, run = merged, run * 2
        return order

    def classes(self, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """A number per start, equal for starts of one bucket whose ``SPAN`` bytes are equal."""
        order = self.sort(starts, bucket)
        s, b = starts[order], bucket[order]
        new = np.r_[True, (b[1:] != b[:-1]) | (self.common(s[1:], s[:-1]) < SPAN)]
        joined = np.flatnonzero(~new)
        reach = np.arange(SPAN)
        for at in range(0, len(joined), 65536):  # verify
            some = joined[at : at + 65536]
            differ = (self.bytes[s[some][:, None] + reach] != self.bytes[s[some - 1][:, None] + reach]).any(1)
            if differ.any():  # a hash collision: sort by the bytes themselves
                texts = [self.bytes[x : x + SPAN].tobytes() for x in starts.tolist()]
                number: dict = {}
                return np.array([number.setdefault(k, len(number)) for k in zip(bucket.tolist(), texts, strict=True)])
        out = np.empty(len(starts), np.int64)
        out[order] = np.cumsum(new)
        return out


def _compare(rows: dict[str, np.ndarray], texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Repeated windows among whole keys: doc, first pos and last start of each run of them."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.r_[0, np.cumsum(sizes)[:-1]]
    suffixes = Suffixes(b"".join(texts))
    repeated = []
    group = np.cumsum(np.r_[True, rows["key"][1:] != rows["key"][:-1]]) - 1
    backs = np.unique(np.concatenate([rows["back"], rows["back"] - rows["starts"] + 1]))
    # offsets from the anchor are independent of each other: they are taken in batches of bounded size
    top, low_end = int(backs.max()), int(backs.min())
    width = max(1, STARTS // max(1, len(texts)))
    for high in range(top, low_end - 1, -width):
        begin = np.maximum(0, rows["back"] - high)
        end = np.minimum(rows["starts"], rows["back"] - (high - width))
        count = np.maximum(0, end - begin)
        row = np.repeat(np.arange(len(texts)), count)
        if not len(row):
            continue
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + begin[row]
        bucket = group[row] * 256 + (rows["back"][row] - step)
        order = np.argsort(bucket, kind="stable")
        row, step, bucket = row[order], step[order], bucket[order]
        number = suffixes.classes(offset[row] + step, bucket)
        pos = rows["pos"][row] + (step << PRINT_BITS)
        order = np.lexsort((pos, rows["doc"][row], number))
        row, step, number, pos = row[order], step[order], number[order], pos[order]
        new = np.r_[True, number[1:] != number[:-1]]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        again = (rows["doc"][row] != rows["doc"][row[lead]]) | (pos != pos[lead])
        repeated.append(np.stack([row[again], step[again]]))
    if not repeated:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    row, step = np.concatenate(repeated, 1)
    order = np.lexsort((step, row))
    row, step = row[order], step[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)][: len(row)])
    end = np.r_[new[1:] - 1, len(row) - 1][: len(new)]
    return rows["doc"][row[new]], rows["pos"][row[new]] + (step[new] << PRINT_BITS), (rows["pos"][row[end]] >> PRINT_BITS) + step[end]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over parts sorted by key: the runs of repeated windows. Keys are gathered until there is a batch of whole ones."""
    held: list[pa.Table] = []
    waiting = 0
    lead = np.empty((4, 0), np.int64)  # key, second half, doc and pos of the current digest's first window

    def settle(table: pa.Table) -> pa.RecordBatch:
        rows = {n: table.column(n).to_numpy() for n in PART_NAMES[:-1]}
        return found(*_compare(rows, table.column("bytes").to_pylist()))

    def found(doc: np.ndarray, pos: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x, pa.int64()) for x in (doc, pos, last)], names=["doc", "pos", "last"])

    for batch in batches:
        digests = batch.column("starts").to_numpy() < 0
        if digests.any():
            own = batch.filter(pa.array(digests))
            full = np.concatenate([lead, np.stack([own.column(n).to_numpy() for n in ("key", "back", "doc", "pos")])], 1)
            new = np.r_[True, (full[:2, 1:] != full[:2, :-1]).any(0)]
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            again = full[:, (full[2] != full[2, first]) | (full[3] != full[3, first])]
            lead = full[:, [first[-1]]]
            yield found(again[2], again[3], again[3] >> PRINT_BITS)
        rest = batch.filter(pa.array(~digests))
        if not rest.num_rows:
            continue
        held.append(pa.Table.from_batches([rest]))
        waiting += rest.num_rows
        if waiting >= 8192:
            table = pa.concat_tables(held)
            keys = table.column("key").to_numpy()
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            if cut:
                yield settle(table.slice(0, cut))
            held, waiting = [table.slice(cut)], table.num_rows - cut
    if held and waiting:
        yield settle(pa.concat_tables(held))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data, kept, removed, runs, at = text.encode(), [], 0, 0, -1
            for start, end in sorted((s["pos"] >> PRINT_BITS, s["last"] + SPAN) for s in spans or ()):
                if start > at:  # a new run
                    kept.append(data[max(at, 0) : start])
                    runs += 1
                    at = start
                removed += max(0, end - at)
                at = max(at, end)
            kept.append(data[max(at, 0) :])
            rows.append((doc, len(data), removed, runs, b"".join(kept)))
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row.

    Null text is empty. A null doc_id comes before all others. Rows that repeat an id and a text are one document and get equal
    results; of rows that repeat an id with different texts, the earlier start comes first, then the lesser text hash. Extra columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    mark = F.pmod(F.xxhash64(text), F.lit(1 << PRINT_BITS))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), mark.alias("mark"), text.alias("text"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                yield _rows(batch.slice(at, 4096))

    met = rows.where(F.octet_length("text") >= SPAN).mapInArrow(runs, ROW)
    met = met.repartition("anchor").sortWithinPartitions("anchor", "shape", "around", "doc", "pos")
    judged = written(met.mapInArrow(_classes, ROW), "anchor-classes")
    print_of = F.col("pos").bitwiseAND(F.lit((1 << PRINT_BITS) - 1)).alias("mark")
    open_rows = judged.where("shape >= 0")
    many = open_rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("anchor", F.lit(True).alias("many"))
    open_rows = open_rows.join(many, "anchor", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    wanted = open_rows.select("doc", print_of, F.struct("pos", "shape", "many").alias("want")).groupBy("doc", "mark").agg(F.collect_set("want").alias("wanted"))
    fetched = rows.join(wanted, ["doc", "mark"]).select("doc", "mark", "text", "wanted").mapInArrow(_parts, PART)
    compared = fetched.repartition("key").sortWithinPartitions("key", "back", "doc", "pos").mapInArrow(_compared, "doc long, pos long, last long")
    spans = judged.where("shape < 0").select("doc", "pos", F.col("around").alias("last")).unionByName(compared)
    of_doc = spans.select("doc", print_of, F.struct("pos", "last").alias("span")).groupBy("doc", "mark").agg(F.collect_list("span").alias("spans"))
    result = rows.join(of_doc, ["doc", "mark"], "left").select("doc", "text", "spans")
    cut = result.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return cut.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
