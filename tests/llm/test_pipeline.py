"""The pipeline against the plain versions of its stages, and each stage on odd rows."""

import brute
import corpus_pipeline as pipeline
from test_pairs import check_packing, expected_pieces

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def has_letter(text):
    return any(c.isalpha() for c in text or "")


def cleaned(docs):
    """Lines dropped as in the contract; the texts themselves."""
    held = {}
    key = lambda x: x.strip(brute.BLANK).translate(brute.UPPER)
    for doc, text in docs:
        for line in text.split("\n"):
            held.setdefault(key(line), set()).add(doc)
    keep = lambda doc, x: len(key(x)) < 20 or len(held[key(x)]) < 3 or max(held[key(x)]) == doc
    return [(doc, "\n".join(x for x in text.split("\n") if keep(doc, x))) for doc, text in docs]


def expected(docs, bench):
    docs = cleaned([d for d in docs if has_letter(d[1])])
    kept = [d for d, r in zip(docs, brute.near_duplicates(docs), strict=True) if r[3]]
    return [d for d, r in zip(kept, brute.decontaminate(kept, bench), strict=True) if not r[5]]


def test_run(spark):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*c).collect()]
    plain = expected(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    check_packing(entry.queries()["pipeline"](spark, SF), expected_pieces(plain))


def test_stages_on_odd_rows(spark):
    line = "a line that is long enough to be counted as one"
    rows = [
        (1, None), (2, ""), (3, "12 % 34"), (4, line), (5, line), (6, line), (7, f"own words here {line}\nand more of it"),
        (8, "word " * 30000), (9, "Same text in two places of the corpus"), (10, "same text in two places of the corpus"), (None, "no id but text"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n int, length long"
    docs = spark.createDataFrame([(d, t, None if d == 4 else "en", None, None, True, 1, 2) for d, t in rows], schema)
    sizes = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "packing":
            assert out.columns == COLUMNS
            docs = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(out.count())
    # the three copies of a line empty two documents, which stay; the emptied ones and the two equal texts
    assert sizes[:4] == [8, 8, 7, 7]


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "packing"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in entry.queries() if q.startswith("op")}
