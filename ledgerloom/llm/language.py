"""Language identification by multilingual mixture inference.

Each language has smoothed trigram probabilities, counted over all training documents. A document is taken as a mixture:
expectation-maximisation estimates the share of every language in it from the trigrams' likelihoods, and the set of
languages is the one with the best likelihood less a penalty per language. The language with the largest share in that
set is the prediction and its share the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texts import hold_only

GRAMS = 1 << 16  # trigrams are hashed into so many classes
SMOOTHING = 0.1
PENALTY = 4.0  # per further language, in units of the log of the number of trigrams
ROUNDS = 12
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the letter trigrams of a text with their counts; runs of other characters count as one space."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.where(letter, codes, 32).astype(np.uint64)
    blank = codes == 32
    codes = codes[~(blank & np.r_[False, blank[:-1]])]
    codes = np.r_[32, codes[int(codes[0] == 32) :], 32].astype(np.uint64)
    if codes[-2] == 32:
        codes = codes[:-1]
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (codes[2:] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    found = (mixed >> np.uint64(48)).astype(np.int64)
    if len(found) > GRAMS // 4:
        counts = np.bincount(found, minlength=GRAMS)
        classes = np.flatnonzero(counts)
        return classes, counts[classes]
    return np.unique(found, return_counts=True)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of the trigram classes, a row per language.

    Uses text and lang of every row given with both; what is collected is ``GRAMS`` counts per language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only(None)
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                classes, counts = trigrams(text)
                totals.setdefault(lang, np.zeros(GRAMS, np.int64))[classes] += counts
        for lang, own in totals.items():
            used = np.flatnonzero(own)
            yield pa.record_batch([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(own[used])], names=["lang", "class", "n"])

    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    rows = known.mapInArrow(count, "lang string, class int, n long").groupBy("lang", "class").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((len(names), GRAMS))
    at = {name: i for i, name in enumerate(names)}
    counts[[at[n] for n in rows.column("lang").to_pylist()], rows.column("class").to_numpy()] = rows.column("n").to_numpy()
    smooth = counts + SMOOTHING
    return names, np.log(smooth / smooth.sum(1, keepdims=True)) if names else counts


def _shares(chances: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages by expectation-maximisation, and the log likelihood."""
    shares = np.full(len(chances), 1 / len(chances))
    total = counts.sum()
    for _ in range(ROUNDS):
        whole = shares @ chances
        shares = shares * (chances @ (counts / whole)) / total
    return shares, float(counts @ np.log(shares @ chances))


def infer(classes: np.ndarray, counts: np.ndarray, logs: np.ndarray) -> tuple[int, float]:
    """The index of the main language and its share among the chosen set of languages."""
    own = logs[:, classes]
    alone = own @ counts
    best = int(np.argmax(alone))
    penalty = PENALTY * np.log(counts.sum() + 1)
    if len(alone) == 1 or counts @ own.max(0) - alone[best] <= penalty:
        return best, 1.0
    chances = np.exp(own - own.max(0))
    offset = float(counts @ own.max(0))
    shares, _ = _shares(chances, counts)
    order = np.argsort(-shares, kind="stable")
    chosen, value, top = (best, 1.0), float(alone[best]), best
    for k in range(2, len(order) + 1):
        some = order[:k]
        part, fit = _shares(chances[some], counts)
        if fit + offset - (k - 1) * penalty <= value:
            break
        top = int(np.argmax(part))
        chosen, value = (int(some[top]), float(part[top])), fit + offset - (k - 1) * penalty
    return chosen


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with lang_pred and score; a row per input row. No letter, no text or an empty model: ``und``, 0."""
    names, logs = model
    alone = "text" not in carry
    schema = docs.select(*carry).schema
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ", lang_pred string, score double"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only(None)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(batch.num_columns - 1 if alone else carry.index("text")).to_pylist():
                classes, counts = trigrams(text)
                best, score = infer(classes, counts, logs) if len(classes) and names else (-1, 0.0)
                langs.append(names[best] if best >= 0 else UNKNOWN)
                scores.append(min(1.0, max(0.0, score)))
            yield pa.record_batch([*batch.columns[: len(carry)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*carry, "lang_pred", "score"])

    return docs.select(*carry, *([F.col("text").alias("_text")] if alone else [])).mapInArrow(judge, out)


def held_out(ids: F.Column) -> F.Column:
    """The fold that is never learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the documents that are not held out. Extra columns are ignored."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, model, ("doc_id", "held_out"))
