"""Best-fit packing by exact-complement hashing.

Only lengths decide a packing, and there are at most ``SIZE`` of them, so the plan is made on the count per length and
stays small whatever the number of documents. For the longest piece left, single lengths and the sums of pairs and
triples are looked up for the gap; a combination that fills it exactly is used as often as its counts allow. What
fits nowhere exactly is packed best-fit, longest first. Each use of a combination empties a length, so a plan has no
more patterns than a few per length. Pieces are then numbered within their length (in salted parts, so that a frequent
length is no single task's work) and look their place up in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.texts import hold_only
from ledgerloom.session import written

SIZE = 2048
END = 0
PART = 50_000
WORDS_HELD = 1_200_000


def token_counter(path: str):
    """text -> token ids as little-endian 32-bit bytes, as the tokenizer gives them for the whole text.

    The tokenizer drops white space and never joins across it, so a text is the sum of its blank-free pieces;
    the ids of a piece are kept and met again. Texts that name a special token go to the tokenizer whole.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    # Lower-case Latin words are what the tokenizer's own normalising and splitting would make of them.
    words = Tokenizer.from_file(path)
    words.normalizer = None
    words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    held: dict[str, bytes] = {"": b""}

    def pack(ids) -> bytes:
        return np.asarray(ids, "<u4").tobytes()

    def learn(names: list[str], coder: Tokenizer) -> None:
        """Encode new pieces as one text; a token belongs to the piece that it starts in. Plain words are the coder's own words."""
        for at in range(0, len(names), 4096):
            part = names[at : at + 4096]
            coded = coder.encode(" ".join(part), add_special_tokens=False)
            if coder is words:
                owner = np.array(coded.word_ids, np.int64)
            else:
                ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
                owner = np.searchsorted(ends, np.array([start for start, _ in coded.offsets], np.int64), side="right")
            ids, cuts = pack(coded.ids), np.searchsorted(owner, np.arange(len(part) + 1)) * 4
            for name, start, end in zip(part, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                held[name] = ids[start:end]

    def encode(texts: list[str]) -> list[bytes]:
        """The texts are split and their pieces told apart in Arrow; each distinct piece is looked up once a call."""
        if len(held) > WORDS_HELD:
            held.clear()
            held[""] = b""
        whole, blank = {}, []
        for i, text in enumerate(texts):
            low = text.lower()
            if any(s in low for s in special):
                whole[i] = pack(tokenizer.encode(text, add_special_tokens=False).ids)
                low = ""
            elif not (text.isascii() or _latin(text)):
                low = text
            # Letters up to U+00FF have one lower case and make no new letters with marks, so fewer spellings are met.
            blank.append(low.replace("\n", " "))
        split = pc.split_pattern(pc.replace_substring_regex(pa.array(blank, pa.large_string()), MARKS, r"\1 \2\3"), " ")
        pieces = split.flatten().dictionary_encode()
        # No piece has a space; one long string becomes Python strings much faster than many Arrow values do.
        names = pc.binary_join(pa.ListArray.from_arrays([0, len(pieces.dictionary)], pieces.dictionary.cast(pa.string())), " ")[0].as_py().split(" ")
        ids = list(map(held.get, names))
        new = [p for p, known in zip(names, ids, strict=True) if known is None]
        plain = [p for p in new if p.isalpha() and (p.isascii() or _latin(p)) and p.islower()]
        learn(plain, words)
        learn(list(set(new).difference(plain)), tokenizer)
        coded = pa.array([held[p] for p in names] if new else ids, pa.large_binary()).take(pieces.indices)
        _, starts, data = coded.buffers()
        ends = np.frombuffer(starts, np.int64, len(coded) + 1)[split.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [whole[i] if i in whole else data[ends[i] : ends[i + 1]].tobytes() for i in range(len(texts))]

    encode.held = held
    return encode


#: Marks that end a word are no part of its tokens; set apart, the word is met more often.
MARKS = r"([a-z])([!-/:-@\[-`{-~]+)( |$)"


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_ENCODERS: dict[str, object] = {}


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each document's pieces; an end token closes each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only(_ENCODERS)
        encode = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, token_counter(tokenizer))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids += END.to_bytes(4, "little")
                    n = len(ids) // 4
                    for i, start in enumerate(range(0, n, size)):
                        own = ids[4 * start : 4 * (start + size)]
                        rows.append((doc, i, start, len(own) // 4, zlib.crc32(own)))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


class Complements:
    """Which single lengths, pairs and triples of available lengths add up to a gap."""

    def __init__(self, counts: np.ndarray, most: int):
        self.counts = counts  # by length; shared with the planner, which lowers them
        self.most = most  # pieces in a combination: 1 to 3
        self.lasts: dict[int, tuple[int, ...]] = {}

    def _open(self, need: tuple[int, ...]) -> bool:
        return all(self.counts[k] >= n for k, n in Counter(need).items())

    def pair(self, gap: int, most: int) -> tuple[int, ...] | None:
        low, high = (gap + 1) // 2, min(gap - 1, most)
        if low > high:
            return None
        firsts = np.arange(high, low - 1, -1)
        both = (self.counts[firsts] > 0) & (self.counts[gap - firsts] > np.where(firsts * 2 == gap, 1, 0))
        at = np.flatnonzero(both)
        return (int(firsts[at[0]]), gap - int(firsts[at[0]])) if len(at) else None

    def fill(self, gap: int, used: int) -> tuple[int, ...] | None:
        """Lengths that fill the gap exactly, largest first, beside one piece of ``used`` that is taken already."""
        self.counts[used] -= 1
        try:
            last = self.lasts.get(gap)
            if last and self._open(last):
                return last
            found = self._find(gap)
            if found:
                self.lasts[gap] = found
            return found
        finally:
            self.counts[used] += 1

    def _find(self, gap: int) -> tuple[int, ...] | None:
        if self.counts[gap] > 0:
            return (gap,)
        if self.most < 2:
            return None
        if two := self.pair(gap, gap - 1):
            return two
        if self.most < 3:
            return None
        for first in np.flatnonzero(self.counts[: gap - 1] > 0)[::-1].tolist():
            if first * 3 < gap:
                break
            self.counts[first] -= 1
            two = self.pair(gap - first, first)
            self.counts[first] += 1
            if two:
                return (first, *two)
        return None


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) with the number of sequences of each.

    Triples can use up short pieces that longer ones need later, so plans with up to triples, pairs, singles and none
    are made, which costs little, and the one with the fewest sequences is taken.
    """
    return min((_plan(counts, size, most) for most in (3, 2, 1, 0)), key=lambda p: sum(times for _, times in p))


def _plan(counts: dict[int, int], size: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []
    sums = Complements(left, most)

    def use(pattern: tuple[int, ...]) -> None:
        need = Counter(pattern)
        times = min(int(left[k]) // n for k, n in need.items())
        for k, n in need.items():
            left[k] -= n * times
        patterns.append((pattern, times))

    if left[size]:
        use((size,))
    for longest in range(size - 1, 0, -1):
        while most and left[longest]:
            rest = sums.fill(size - longest, longest)
            if not rest:
                break
            use((longest, *rest))
    return patterns + _best_fit(left, size)


def _best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: sequences with equal content are one entry."""
    gaps: list[int] = []  # sorted gaps of the open sequences
    at_gap: dict[int, list[list]] = {}

    def put(pattern: tuple[int, ...], times: int, gap: int) -> None:
        if gap not in at_gap:
            insort(gaps, gap)
        at_gap.setdefault(gap, []).append([pattern, times])

    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            i = bisect_left(gaps, length)
            if i == len(gaps):
                each = size // length
                whole, rest = divmod(todo, each)
                if whole:
                    put((length,) * each, whole, size - each * length)
                if rest:
                    put((length,) * rest, 1, size - rest * length)
                break
            gap = gaps[i]
            pattern, times = at_gap[gap].pop()
            if not at_gap[gap]:
                del at_gap[gap]
                gaps.pop(i)
            each = min(gap // length, todo)
            full = min(times, todo // each)
            put(pattern + (length,) * each, full, gap - each * length)
            todo -= each * full
            if full < times:
                put(pattern, times - full, gap)
    return [(pattern, times) for entries in at_gap.values() for pattern, times in entries if times]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: the first rank of each entry, and that entry's first sequence, copies and first offset."""
    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: Counter[int] = Counter()
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in sorted(Counter(pattern).items(), reverse=True):
            entries.setdefault(length, []).append((taken[length], sequence, copies, offset))
            taken[length] += copies * times
            offset += copies * length
        sequence += times
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in entries.items()}


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    Null or empty text is the end token alone. Each input row is a document of its own, whatever its id; extra columns are ignored.
    """
    cut = written(pieces(docs, tokenizer, size), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    parts = 1 + max(counts.values(), default=0) // PART
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    dealt = written(
        cut.withColumn("part", salt).withColumn(
            "rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
        ),
        "ranked-pieces",
    )
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = dealt.join(sizes.select("length", "part", before.alias("before")), ["length", "part"])
    ranked = ranked.select(*NAMES, (F.col("before") + F.col("rank")).alias("rank"))
    places = _places(plan(counts, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                own = lengths == length
                first, sequence, copies, offset = places[length]
                entry = np.searchsorted(first, ranks[own], side="right") - 1
                inside = ranks[own] - first[entry]
                sequences[own] = sequence[entry] + inside // copies[entry]
                offsets[own] = offset[entry] + inside % copies[entry] * length
            columns = [batch.column(n) for n in NAMES]
            yield pa.record_batch([*columns, pa.array(sequences), pa.array(offsets)], names=[*NAMES, "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
