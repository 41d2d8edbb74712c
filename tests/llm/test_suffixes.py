"""Repeat removal against a dictionary of all windows."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import queries as q
from ledgerloom.llm import suffixes

SF = "/root/testdata/sf0.01"


def check(df, docs):
    got = suffixes.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(brute.remove_repeats(docs), key=repr)


def random_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "été", "日本語", "running", "a", "x" * 30, "tion", "\n", "ab" * 20]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(10, 60))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(8)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(rng.randrange(30))))
        text = " ".join(parts)
        at = rng.randrange(len(text) + 1)
        out.append((rng.randrange(10**6), text[:at] + rng.choice(["", "!", "~~"]) + text[at:]))
    return list({d: (d, t) for d, t in out}.values())


@pytest.mark.parametrize("many", [20_000, 3])
def test_random(spark, monkeypatch, many):
    monkeypatch.setattr(suffixes, "MANY", many)
    docs = random_docs(many, 150)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 11)  # groups run over many batches
    try:
        check(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd(spark):
    block = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(140))
    docs = [
        (1, None), (2, ""), (3, "short"), (4, block), (4, block), (5, block), (6, "x" + block + "y" + block), (7, block[:99]), (8, block[20:120]), (9, block[1:101] + block[3:120]),
        (10, "a" * 5000), (11, "a" * 150), (12, "ab" * 400 + "a" * 120), (None, block[:120]), (None, None), (13, "é" * 90), (14, "é" * 49 + "z" + "é" * 50), (-5, "tail " + block[30:]),
    ]
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, doc int, mark string, pos int")
    check(df, docs)
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_long_text_in_segments(spark, monkeypatch):
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    docs = [(1, base), (2, base[500:2500] + "#" + base[:700])]
    monkeypatch.setattr(suffixes, "SEGMENT", 256)
    rows = {d: 0 for d, _ in docs}
    for d, t in docs:
        for first, last, place, _ in suffixes.anchors(t.encode()):
            assert ((place - first) <= suffixes.SPAN - suffixes.GRAM).all() and (place >= last).all()
            rows[d] += int((last - first + 1).sum())
    assert rows == {d: len(t) - 99 for d, t in docs}
    check(spark.createDataFrame(docs, "doc_id long, text string"), docs)


def test_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in q.op7_suffixes(spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got) == sorted(brute.remove_repeats(docs))


def test_merge_sort():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 99, 4000, dtype=np.uint8)) + b"ab" * 300 + b"a" * 400
    starts = np.arange(len(text) - suffixes.SPAN + 1)
    bucket = np.sort(rng.integers(0, 3, len(starts)))
    held = suffixes.Suffixes(text)
    order = held.sort(starts, bucket)
    keys = [(b, text[s : s + suffixes.SPAN]) for s, b in zip(starts[order].tolist(), bucket[order].tolist(), strict=True)]
    assert keys == sorted(keys) and sorted(order) == list(range(len(starts)))
    numbers = held.classes(starts, bucket)
    assert len(set(numbers.tolist())) == len(set(keys))
