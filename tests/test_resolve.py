import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import lcs_length, length_ratio_ok
from ledgerloom.operators import resolve as R
from ledgerloom.sources.seeds import seed_names

NO_MATCH = [
    "Hungry Labs", "Habit Labs", "Mixed Media Labs", "Canopy Labs", "Kimono Labs", "Clara Labs", "Akido Labs", "Shift Labs",
    "Tara AI", "Heroic Labs", "Harmi Ai", "AI Lottery Predictor", "Chinnu Labs", "ImagineVid AI", "Pendulum AI",
    "AI Tools Directory", "B2B AI Directory", "SkillyTalk AI", "Audiobeta", "Tab", "L.", "SnapMagic", "HER",
    "Magic Instruments", "MagicBus", "GL", "Deepika Sharma", "buckramstudio", "Ben and Jerrys Ice Cream LLC", "", "  ",
]
MATCH = {
    "OpenAI": ("OpenAI", "exact_canonical"), "OpenAI, Inc.": ("OpenAI", "exact_canonical"), "Open AI": ("OpenAI", "exact_alias"),
    "Anthropic PBC": ("Anthropic", "exact_canonical"), "DeepMind": ("Google DeepMind", "exact_alias"),
    "11Labs": ("ElevenLabs", "exact_alias"), "Scale.ai": ("Scale AI", "exact_alias"),
    "huggingface.co": ("Hugging Face", "exact_alias"), "Antropic": ("Anthropic", "fuzzy"),
}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for ca in a:
        last = 0
        for j, cb in enumerate(b, 1):
            keep = row[j]
            row[j] = last + 1 if ca == cb else max(row[j], row[j - 1])
            last = keep
    return row[-1]


def test_known_names(spark):
    names = spark.createDataFrame([(n, 1) for n in [*NO_MATCH, *MATCH]], "raw_name string, records bigint")
    rows = {r.raw_name: r for r in R.resolve_distinct(names, seed_names(spark)).collect()}
    assert len(rows) == len(NO_MATCH) + len(MATCH)
    for name in NO_MATCH:
        assert (rows[name].method, rows[name].canonical_name, rows[name].confidence) == ("no_match", name, 0.0)
    for name, (canonical, method) in MATCH.items():
        assert (rows[name].canonical_name, rows[name].method) == (canonical, method)
    assert rows["Antropic"].confidence == 0.941
    assert rows["OpenAI"].confidence == 1.0


def test_null_name_stays_null(spark):
    names = spark.createDataFrame([(None, 1)], "raw_name string, records bigint")
    [row] = R.resolve_distinct(names, seed_names(spark)).collect()
    assert (row.canonical_name, row.method) == (None, "no_match")


def test_lcs_length(spark):
    rng = random.Random(3)
    pairs = [("".join(rng.choices("abc", k=rng.randint(1, 9))), "".join(rng.choices("abc", k=rng.randint(1, 9)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n")).collect():
        assert row.n == lcs(row.a, row.b)


def test_length_ratio(spark):
    df = spark.createDataFrame([("aaaaa", "aaaaaaaa"), ("aaaaa", "aaaaaaaaa"), ("", "a")], "a string, b string")
    assert [r[0] for r in df.select(length_ratio_ok(F.col("a"), F.col("b"), 1.6)).collect()] == [True, False, False]


@pytest.mark.parametrize("cutoff", [80, 85, 90, 95, 100])
def test_fuzzy_equals_brute_force(spark, cutoff):
    """Every pair compared in plain Python, over names made by random edits."""
    rng = random.Random(cutoff)
    letters = "abcde "
    seeds = list({"".join(rng.choices(letters, k=rng.randint(3, 34))).strip() or "x" for _ in range(60)})
    names = set()
    for seed in seeds:
        for _ in range(6):
            chars = list(seed)
            for _ in range(rng.randint(0, 5)):
                spot = rng.randrange(len(chars) + 1)
                if rng.random() < 0.5 and chars:
                    chars.pop(min(spot, len(chars) - 1))
                else:
                    chars.insert(spot, rng.choice(letters))
            names.add("".join(chars))
    names.discard("")
    expected = {}
    for name in names:
        best = None
        for order, seed in enumerate(seeds):
            total, common = len(name) + len(seed), lcs(name, seed)
            if 200 * common >= cutoff * total and max(len(name), len(seed)) <= 1.6 * min(len(name), len(seed)):
                score = 2.0 * common / total
                if best is None or score > best[0]:
                    best = (score, order)
        if best:
            expected[name] = seeds[best[1]]
    left = spark.createDataFrame([(n,) for n in names], "norm string")
    right = spark.createDataFrame([(s, s, i) for i, s in enumerate(seeds)], "cand string, cand_canonical string, cand_order int")
    got = {r.norm: r.fuzzy_canonical for r in R.best_fuzzy(left, right, cutoff=cutoff).collect()}
    assert got == expected and len(expected) > 30


def test_a_junk_name_has_no_probes(spark):
    candidates = R.canonical_dimension(seed_names(spark))
    names = spark.createDataFrame([("x" * 5000,), ("antropic",)], "norm string")
    probes = R.name_probes(names, "norm", 90, R.candidate_lengths(candidates))
    assert {r.norm for r in probes.select("norm").distinct().collect()} == {"antropic"}


def test_cutoff_limits(spark):
    left = spark.createDataFrame([("a",)], "norm string")
    with pytest.raises(ValueError):
        R.best_fuzzy(left, left, cutoff=50)


def test_alias_collision_last_writer_wins(spark):
    seeds = spark.createDataFrame([("One", ["shared"], 0), ("Two", ["Shared Inc"], 1)], "canonical string, aliases array<string>, seq int")
    dim = {r.norm: r.canonical for r in R.alias_dimension(seeds).collect()}
    assert dim["shared"] == "Two"


def test_method_counts_are_zero_filled(spark):
    startups = spark.createDataFrame(
        [(("s", "u1"), ("OpenAI", (1,))), (("s", "u2"), ("OpenAI", (1,))), (("s", "u3"), (None, (1,)))],
        "source struct<name:string,url:string>, content struct<entityName:string,data:struct<employeeCount:bigint>>")
    products = spark.createDataFrame(
        [(("s", "u4"), ("Nobody Known", None)), (("s", "u5"), ("", None))],
        "source struct<name:string,url:string>, content struct<startupName:string,pricingModel:string>")
    names = R.name_union(startups, products)
    counts = R.method_counts(R.resolve_distinct(R.distinct_names(names), seed_names(spark)))
    assert {r.method: r.records for r in counts.collect()} == {
        "exact_alias": 0, "exact_canonical": 2, "fuzzy": 0, "no_match": 1}


def test_mapping_log_with_a_hot_name(spark):
    rows = [(f"u{i}", "Open AI" if i % 3 else f"Name {i}") for i in range(300)]
    names = spark.createDataFrame(rows, "url string, raw_name string")
    log = R.mapping_log(names, seed_names(spark), "url", min_hot_rows=50).collect()
    assert len(log) == 300 and {r.url for r in log} == {u for u, _ in rows}
    assert all(r.canonical_name == ("OpenAI" if r.raw_name == "Open AI" else r.raw_name) for r in log)
