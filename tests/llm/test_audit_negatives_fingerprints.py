"""Filter audit, hard negatives and fingerprints against plain Python, with odd rows."""

import hashlib
import itertools
import math
from collections import Counter

import brute
import numpy as np
import pytest

from ledgerloom.llm import filter_audit, fingerprints, hard_negatives, minhash
from ledgerloom.llm import queries as q

SF = "/root/testdata/sf0.01"
LONG = " ".join(f"word{i % 150}" for i in range(400))
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one $ TWO", ""), (5, LONG, "a"), (6, LONG, "b"), (6, LONG, "b"), (7, LONG + " $", "a"),
    (8, "x " * 300, "a"), (9, "X" * 30000, "b"), (None, LONG, "a"), (None, None, None), (10, LONG.upper(), "hot"), (11, "é ß " * 120, "hot"), (12, LONG, "hot"),
]
LABELS = [(5, 1, 1), (5, 0, 0), (6, 1, None), (7, 0, 1), (12, None, 1), (None, 1, 1), (99, 1, 1), (8, 1, 0)]


def fails(docs):
    first = {}
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    out = []
    for doc, text, _ in docs:
        text = text or ""
        words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
        out.append((
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            any(c in "#$%&*|" for c in text), doc is not None and first[text] < doc,
        ))
    return out


def audit(docs, labels):
    good = {d for d, quality, _ in labels if quality == 1 and d is not None}
    bad = {d for d, _, toxic in labels if toxic == 1 and d is not None}
    rows, flags = {}, fails(docs)
    for part in {p or "" for _, _, p in docs}:
        own = [(d, f) for (d, _, p), f in zip(docs, flags) if (p or "") == part]
        removals = Counter()
        for order in itertools.permutations(range(5)):
            left = list(own)
            for step, i in enumerate(order, 1):
                gone = [x for x in left if x[1][i]]
                kept = [x for x in left if not x[1][i]]
                removals[i] += len(gone)
                rows[part, "".join("ABCDE"[k] for k in order), step] = [
                    len(kept), len(gone), sum(f[i] for _, f in own) - len(gone), sum(f[i] and sum(f) == 1 for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in bad for d, _ in gone), i,
                ]
                left = kept
        for key, row in rows.items():
            if key[0] == part:
                row[-1] = removals[row[-1]]
    return {k: tuple(v) for k, v in rows.items()}


def test_filter_audit(spark):
    docs = spark.createDataFrame([(*r, 1, "m", 2) for r in ODD], "doc_id long, text string, source string, good int, digest string, n int")
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, source string")
    found = filter_audit.audit_documents(docs, labels)
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in found.collect()}
    assert got == audit(ODD, LABELS)
    assert filter_audit.audit_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", i % 2 == 0, i % 3 == 0, i % 5 == 0, True) for i in range(60)], "p string, even boolean, third boolean, fifth boolean, all_ boolean")
    found = filter_audit.audit(rows, ("even", "third"), "p", {"fifth": "fifths"}).collect()
    assert {(r.filter_order, r.step): (r.removed, r.fifths, r.shapley) for r in found} == {
        ("eventhird", 1): (30, 6, 50), ("eventhird", 2): (10, 2, 30), ("thirdeven", 1): (20, 4, 30), ("thirdeven", 2): (20, 4, 50),
    }
    with pytest.raises(ValueError):
        filter_audit.audit(rows, ("even",) * 9, "p", {})


def mined(rows, n_positives=5, n_negatives=10):
    own = {}
    for vec_id, vector, label in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2] is None, r[2] or 0)):
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(float(x) * 256) for x in vector):
            continue
        own.setdefault(vec_id, (label, [math.floor(float(x) * 256) for x in vector]))
    out = set()
    for anchor, (label, vector) in own.items():
        if anchor % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, lab) for i, (lab, v) in own.items() if i != anchor and len(v) == len(vector))
            for minus, positive, _ in [s for s in scored if s[2] == label][:n_positives]:
                inside = [s for s in scored if s[2] != label and 30 * -minus <= 100 * -s[0] <= 90 * -minus][:n_negatives]
                out |= {(anchor, positive, k, i, -minus if -minus < 1 << 63 else None, -s if -s < 1 << 63 else None) for k, (s, i, _) in enumerate(inside, 1)}
    return out


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 150)
    monkeypatch.setattr(hard_negatives, "CHUNK", 3)
    rng = np.random.default_rng(12)
    vectors = rng.normal(0, 0.3, (700, 6))
    vectors[100:250] = vectors[100]  # ties, a hot vector among anchors and rows
    vectors[300] = 0
    rows = [(i, v.tolist(), int(i % 4)) for i, v in enumerate(vectors)]
    rows += [(1000, None, 1), (1001, [0.1] * 6, None), (1002, [0.1, None] * 3, 1), (1003, [float("nan")] + [0.1] * 5, 1), (1004, [float("inf")] * 6, 1)]
    rows += [(1100, [], 1), (1200, [0.5] * 3, 1), (1201, [0.5] * 3, 1), (1202, [0.4] * 3, 2), (None, [0.2] * 6, 1), (1300, [1e308] * 6, 1), (5, [9.0] * 6, 9)]
    rows += [(2000, [1e12, -1e12], 3), (2001, [1e12, 1.0], 3), (2002, [6e11, 0.0], 1), (2003, [5e11, 3.0], 1), (2100, [1e7, 2e7], 3), (2101, [2e7, 2e7], 3), (2102, [1e7, 1e7], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, vec string, rank int").repartition(5)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    found = hard_negatives.hard_negatives(df)
    expected = mined(rows)
    assert {tuple(r) for r in found.select(*columns).collect()} == expected and len(expected) > 100
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(0, 20, (4000, 4)))
    rows[17] = 400  # far ahead of the others for this anchor
    lists, anchor = hard_negatives.Lists(np.arange(4000), rows), np.array([3.0, 1.0, 2.0, 1.0])
    met = sum(len(places) for places, _, threshold in itertools.takewhile(lambda x: x[2] is None or x[2] >= 2800, lists.read(anchor)))
    best = hard_negatives.Best(1)
    hard_negatives.mine(lists, anchor, np.ones(4000, bool), [best])
    assert best.rows == [(-2800, 17)] and met < 400


def edits(docs):
    """Plain version of the edited texts: rows in order of id, then of the digest of the text."""
    held = sorted((r for r in docs if r[0] is not None), key=lambda r: (r[0], fingerprints._digest(r[1] or "")))
    out = []
    for i, (doc, text) in enumerate(held):
        text, following = text or "", held[(i + 1) % len(held)][1] or ""
        out.append((doc, text, text[: len(text) - len(text) // 2] + following[: len(text) // 2], following))
    return out + [(None, t or "", (t or "")[: len(t or "") - len(t or "") // 2], "") for d, t in docs if d is None]


def plain_signature(text):
    runs = {int(x) >> 33 for x in fingerprints.shingles(text)}
    values = [(int(a), int(b)) for a, b in zip(fingerprints._FACTORS[:, 0], fingerprints._SHIFTS[:, 0])]
    return [min([(a * x + b) % fingerprints.PRIME for x in runs] or [fingerprints.PRIME]) & 0xFFFF for a, b in values]


@pytest.mark.parametrize("rows_a_stretch", [1, 3, 2048])
def test_fingerprints(spark, monkeypatch, rows_a_stretch):
    monkeypatch.setattr(fingerprints, "STRETCH_ROWS", rows_a_stretch)
    monkeypatch.setattr(fingerprints, "OUT_ROWS", 2)
    docs = [(d, t) for d, t, _ in ODD] + [(20, "a b c"), (21, "A b c"), (22, "a b c d"), (40, LONG.replace("word3 ", "x ")), (-5, "first \U0001f600 of all")]
    df = spark.createDataFrame([(*r, "s", 1) for r in docs], "doc_id long, text string, signature string, extra int").repartition(3)
    found = fingerprints.edited(df).collect()

    def line(doc, text, changed, following):
        own, other, after = (plain_signature(t) for t in (text, changed, following))
        alike = lambda x, y: round(sum(a == b for a, b in zip(x, y)) / len(x), 9)
        code = lambda s: np.array(s, np.uint16).tobytes().hex()
        return (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), code(own), code(other), alike(own, other), alike(own, after))

    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in found]
    assert sorted(got, key=repr) == sorted((line(*e) for e in edits(docs)), key=repr)
    assert fingerprints.fingerprint(df.limit(0)).count() == 0


def test_fingerprint_classes(spark):
    rng = np.random.default_rng(9)
    vocabulary = [f"v{i}" for i in range(500)]
    docs, n = [(1, None), (2, ""), (3, "one two"), (4, "One two"), (None, "one two")], 10
    for group in range(8):
        base = rng.choice(vocabulary, 120).tolist()
        for copy in range(25):
            own = list(base)
            for at in rng.integers(0, 120, copy // 6):
                own[at] = f"edit{n}"
            docs.append((n, " ".join(own)))
            n += 1
    found = fingerprints.fingerprint(spark.createDataFrame(docs, "doc_id long, text string"))
    runs = {d: {tuple((t or "").lower().split()[i : i + 5]) for i in range(max(1, len((t or "").split()) - 4))} - {()} for d, t in docs if d is not None}
    links = [(a, b) for a, b in itertools.combinations(runs, 2) if runs[a] and runs[b] and 10 * len(runs[a] & runs[b]) >= 8 * len(runs[a] | runs[b])]
    assert {r.doc_id: r.class_id for r in found.where("doc_id IS NOT NULL").collect()} == {d: brute.roots(runs, links).get(d, d) for d in runs}


def test_near_texts_behind_other_heads(spark):
    """Two near texts of large ids share bands only in lists that smaller ids head, which are near to neither."""
    rng = np.random.default_rng(21)
    base = [f"w{i}" for i in range(200)]

    def edited_at(places, name):
        return " ".join(f"{name}{i}" if i in places else word for i, word in enumerate(base))

    docs = [(n, edited_at(set(rng.permutation(np.arange(2, 198, 8))[:8].tolist()), f"head{n}x")) for n in range(1, 161)]
    docs += [(1000, " ".join(base)), (1001, edited_at({100}, "own"))]
    found = {r.doc_id: r.class_id for r in fingerprints.fingerprint(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[1000] == found[1001] == 1000


def test_posting_lists_carry_ids_alone(spark):
    reps = spark.createDataFrame([(n, 5, bytearray(4 * minhash.COORDS), bytearray(32)) for n in (1, 2)], "id long, n long, signature binary, sketch binary")
    posted = minhash.postings(reps)
    assert posted.columns == ["token", "id"] and posted.count() == 2 * minhash.PREFIX


def test_fingerprint_query(spark):
    rows = q.op13_fingerprints(spark, SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = {(d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edits(docs)}
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in rows} == expected and len(rows) == len(docs)
    texts = dict(docs)
    alike = {}
    for r in rows:
        assert alike.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert np.mean([r.near_edited for r in rows]) > 0.3 > 0.01 > np.mean([r.near_next for r in rows])


def test_audit_flags(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = {r.doc_id: tuple(r[c] for c in "ABCDE") for r in filter_audit.failures(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert got == {d[0]: f for d, f in zip(docs, fails(docs))}
