"""Near-duplicate operators, language and packing against plain Python."""

import collections
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import components, embeddings, language, line_dedup, minhash, packing, texts
from ledgerloom.llm import queries as q

SF = "/root/testdata/sf0.01"
BASE = " ".join(f"alpha{i} beta{i}" for i in range(60))
ODD = [
    (1, None), (2, ""), (3, " \n "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two"), (7, "one two"), (8, BASE), (9, BASE.upper()),
    (10, BASE + " tail"), (11, BASE.replace("alpha7 ", "x ")), (12, "w " * 50000), (13, "w w w"), (None, BASE), (None, None),
    (14, "a b c d e f"), (15, "a b c d e f g"), (16, "a b c d e"), (17, "É b"), (18, "é b"), (19, "123 456 <|ENDOFTEXT|> <|endoftext|>"),
]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, None, 3, "k", 1) for r in ODD], "doc_id long, text string, lang string, n long, token string, component long")


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2300)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    links = [(a, b) for a, b in links if a != b]
    expected = brute.roots({x for link in links for x in link}, links)
    assert found == expected


def test_minhash(spark, odd, docs):
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert rows(minhash.near_duplicates(odd), *columns) == sorted(brute.near_duplicates(ODD), key=repr)
    assert rows(q.op4_minhash(spark, SF), *columns) == sorted(brute.near_duplicates(docs), key=repr)
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_minhash_large_groups(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"v{i}" for i in range(300)]
    out = []
    for group in range(6):
        base = rng.choice(vocabulary, 80).tolist()
        for _ in range(60):
            own = list(base)
            for at in rng.integers(0, 80, rng.integers(0, 9)):
                own[at] = str(rng.choice(vocabulary))
            out.append((len(out), " ".join(own)))
    got = rows(minhash.near_duplicates(spark.createDataFrame(out, "doc_id long, text string")), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates(out), key=repr)


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    out = [base[i % 60] * rng.uniform(0.5, 3) + rng.normal(size=16) * rng.choice([0, 0.05, 0.3]) for i in range(700)]
    out += [base[0]] * 80 + [base[1] + rng.normal(size=16) * 0.1 for _ in range(150)]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]


@pytest.mark.parametrize("block", [64, 4096])
def test_embeddings(spark, block):
    plain = vectors()
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [None] + [1.0] * 15), (5004, [float("nan")] * 16), (5005, [float("inf")] * 16), (5006, [1.0, 2.0]), (5007, [2.0, 4.0]), (None, plain[0][1]), plain[3]]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in plain + odd], "vec_id long, embedding array<float>, label int, digest string, n int")
    matrix = embeddings.unit(np.array([v for _, v in plain]))
    near = matrix @ matrix.T >= 0.9
    np.fill_diagonal(near, False)
    root = brute.roots(range(len(plain)), zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
    expected = [(i, int(near[i].sum()), root[i], root[i] == i) for i, _ in plain]
    expected += [(i, 0, i, True) for i in range(5000, 5006)] + [(5006, 1, 5006, True), (5007, 1, 5006, False), (None, 0, None, True), expected[3]]
    columns = ("vec_id", "n_links", "component_id", "kept")
    assert rows(embeddings.near_duplicates(df, block=block), *columns) == sorted(expected, key=repr)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_table(spark):
    assert q.op3_embeddings(spark, SF).where("kept").count() == spark.read.parquet(f"{SF}/embeddings.parquet").count()


def test_language(spark, odd):
    got = q.op10_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    assert got.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    assert got.where("held_out <> (crc32(cast(doc_id AS string)) % 4 = 2) OR NOT score BETWEEN 0 AND 1").count() == 0
    model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    judged = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(odd, model).where("doc_id < 5").collect()}
    assert all(judged[i] == ("und", 0.0) for i in (1, 2, 3)) and judged[4][0] != "und"
    assert language.identify(odd).where("lang_pred <> 'und'").count() == 0
    assert language.identify(odd.limit(0)).count() == 0


def test_language_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, logs = language.train(docs)
    some = {r.lang: r.text for r in docs.where("length(text) > 3000").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    mixed = some["en"][:2000] + " " + some["fr"][:1000]
    best, share = language.infer(*language.trigrams(mixed), logs)
    assert names[best] == "en" and 0.55 < share < 0.8


def check_packing(result, expected, size=2048):
    got = [tuple(r) for r in result.select("doc_id", "piece", "start", "length", "ids_crc32").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    by = collections.defaultdict(list)
    for r in result.select("sequence_id", "offset", "length").collect():
        by[r[0]].append((r[1], r[2]))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def expected_pieces(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(q.tokenizer_path())
    out = []
    for doc, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for i, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            out.append((doc, i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def test_packing(spark, odd, docs):
    expected = expected_pieces(docs)
    used = check_packing(q.op2_pack(spark, SF), expected)
    assert used <= 1.01 * sum(r[3] for r in expected) / 2048 + 1
    check_packing(packing.pack(odd, q.tokenizer_path()), expected_pieces(ODD))
    assert packing.pack(odd.limit(0), q.tokenizer_path()).count() == 0


def test_tokens_of_pieces():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(q.tokenizer_path()), packing.token_counter(q.tokenizer_path())
    for text in ("Hello, it's   a\ttest\n\nOK’s don't <|endoftext|> x", "İstanbul ΑΣ Σ.", "ä é", "", "x\x1cy z\x85w", "<|EndOfText|>", "IT'S 12²"):
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_marks_make_no_new_words():
    """Marks that end a word are looked up apart, wherever that leaves the tokenizer's ids as they are."""
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(q.tokenizer_path()), packing.token_counter(q.tokenizer_path())
    texts = ["word word$$$ word.*** word,!! Word***", "word's word' word'. word<\u0338 word<b 7... é*** a--b", "", " \n ", "word~\nword`"]
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):  # new pieces, and pieces met again
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)] == expected
    encode = packing.token_counter(q.tokenizer_path())
    encode(texts[:1])
    assert set(encode.held) == {"", "word", "$$$", ".***", ",!!", "***"}


@pytest.mark.parametrize("lengths", [[1, 2048, 2048, 2047], [1500] * 10, [700, 900, 1100, 3] * 200, list(range(1, 2049)), [5] * 5000, []])
def test_plan(lengths):
    used, patterns = collections.Counter(), packing.plan(collections.Counter(lengths))
    for pattern, times in patterns:
        assert sum(pattern) <= 2048 and times > 0
        for length in pattern:
            used[length] += times
    assert used == collections.Counter(lengths)
    assert sum(n for _, n in patterns) <= 1.25 * sum(lengths) / 2048 + 1 or min(lengths) > 683


def test_minhash_long_lists_in_blocks(spark, monkeypatch):
    """One group of near copies, many of them too far from the rest, compared in several blocks."""
    monkeypatch.setattr(minhash, "LONG", 20)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(9)
    vocabulary = [f"v{i}" for i in range(4000)]
    base = rng.choice(vocabulary, 120).tolist()
    out = []
    for _ in range(140):
        own = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 26)):
            own[at] = str(rng.choice(vocabulary))
        out.append((len(out), " ".join(own)))
    expected = sorted(brute.near_duplicates(out), key=repr)
    assert 3 < sum(r[3] for r in expected) < 130
    got = rows(minhash.near_duplicates(spark.createDataFrame(out, "doc_id long, text string")), "doc_id", "n_shingles", "component_id", "kept")
    assert got == expected


def test_lists_are_filtered_by_another_worker_than_they_are_posted_by(spark, monkeypatch):
    """Python functions in one stage are as many workers beside each task's heap: the lists are written in between."""
    plans = []

    def shared(posted, inner=minhash._shared):
        plans.append(posted._jdf.queryExecution().optimizedPlan().toString())
        return inner(posted)

    monkeypatch.setattr(minhash, "_shared", shared)
    docs = spark.createDataFrame([(1, BASE), (2, BASE + " tail"), (3, "other words")], "doc_id long, text string")
    assert rows(minhash.near_duplicates(docs), "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3)]
    assert len(plans) == 1 and "MapInArrow" not in plans[0]


def test_word_tables_go_before_other_operators():
    table = {b"word": 1}
    texts.hold_only(table)
    texts.hold_only(table)
    assert table
    texts.hold_only(None)
    assert not table


def test_operators_without_word_tables_empty_those_of_others(spark, monkeypatch):
    """Language and lines run in workers that may still hold the words of packing."""
    docs, used = spark.createDataFrame([(1, "some words", "en")], "doc_id long, text string, lang string"), []
    inner = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **k: used.append(f) or inner(self, f, *a, **k))
    language.predict(docs, language.train(docs))
    line_dedup.LineIndex(spark).insert(docs).clean(docs)
    assert len(used) == 5  # train, predict; holdings of insert and clean, clean
    for f in used:
        table = {b"word": 1}
        texts.hold_only(table)
        list(f(iter([])))
        assert not table
