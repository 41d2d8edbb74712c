import random
from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.operators import dedup as D
from ledgerloom.operators import ingest as I
from ledgerloom.operators.ranking import first_success, limit_new, newest_first, prominence_topk, top_rows
from ledgerloom.operators.skew import lookup

NOW = datetime(2026, 7, 19, 12)
NOW_COL = F.lit("2026-07-19T12:00:00Z").cast("timestamp")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_first_and_latest_per_key(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), ("a", 3, "w")]
    df = frame(spark, rows, "k string, seq int, v string")
    assert {tuple(r) for r in D.first_per_key(df, ["k"], "seq").collect()} == {("a", 1, "y"), ("b", 5, "z")}
    assert {tuple(r) for r in D.latest_per_key(df, ["k"], "seq").collect()} == {("a", 3, "w"), ("b", 5, "z")}


def test_rank_filter_is_applied_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    plan = D.first_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_require_drops_missing_keys(spark):
    df = frame(spark, [("a",), ("",), (None,)], "url string")
    assert [r.url for r in D.require(df, "url").collect()] == ["a"]


def test_both_exclusions_agree(spark):
    rng = random.Random(1)
    new = frame(spark, [(f"u{rng.randint(0, 99)}", i) for i in range(200)], "url string, seq int")
    seen = frame(spark, [(f"u{rng.randint(0, 99)}", "NEWS") for _ in range(80)], "url string, record_type string")
    firsts = D.first_per_key(new, ["url"], "seq")
    one = {tuple(r) for r in D.exclude_seen(firsts, seen, "url").collect()}
    two = {tuple(r) for r in D.exclude_seen_small_batch(firsts, seen, "url").collect()}
    assert one == two and one and not {u for u, _ in one} & {r.url for r in seen.collect()}


def test_marking_twice_adds_nothing(spark):
    seen = frame(spark, [("a",)], "url string")
    new = frame(spark, [("a",), ("b",), ("b",), (None,)], "url string")
    rows = D.new_seen_keys(new, seen, "url", "JOB", NOW_COL).collect()
    assert [(r.url, r.record_type) for r in rows] == [("b", "JOB")]
    again = D.new_seen_keys(new, seen.unionByName(frame(spark, [("b",)], "url string")), "url", "JOB", NOW_COL)
    assert again.count() == 0


def test_decide_settles_by_first_row_and_accounts_for_every_input(spark):
    rows = [("a", 1, NOW), ("a", 2, None), ("b", 3, None), ("c", 4, datetime(2026, 7, 1)), ("d", 5, NOW), ("d", 6, NOW), ("e", 7, None)]
    df = frame(spark, rows, "url string, seq int, dt timestamp")
    seen = frame(spark, [("d",), ("d",)], "url string")
    drop = I.decide(df, seen, "url", ["seq"], I.freshness_reason(F.col("dt"), NOW_COL, "drop"))
    assert {r.url: (r.outcome, r.copies) for r in drop.collect()} == {
        "a": ("saved", 2), "b": ("dateless", 1), "c": ("stale", 1), "d": ("already_seen", 2), "e": ("dateless", 1)}
    keep = I.decide(df, seen, "url", ["seq"], I.freshness_reason(F.col("dt"), NOW_COL, "keep"))
    assert {r.url for r in keep.where("outcome = 'saved'").collect()} == {"a", "b", "e"}
    totals = I.accounting(drop).agg(F.sum("input_rows"), F.sum("keys"), F.sum("duplicates")).first()
    assert tuple(totals) == (7, 5, 2)


def test_which_keys_are_marked(spark):
    rows = [("a", "saved"), ("b", "stale"), ("c", "irrelevant"), ("d", "dateless"), ("e", "invalid"), ("f", "already_seen")]
    df = frame(spark, rows, "url string, outcome string")
    assert {r.url for r in I.keys_to_mark(df, "url", True).collect()} == {"a", "b", "c", "d"}
    assert {r.url for r in I.keys_to_mark(df, "url", False).collect()} == {"a"}


def test_prominence_order(spark):
    rows = [("big", False, 500, 0), ("flagged", True, 5, 1), ("null", None, None, 2), ("small", False, 10, 3), ("tie", False, 500, 4)]
    df = frame(spark, rows, "name string, top boolean, size int, seq int")
    assert [r.name for r in prominence_topk(df, "top", "size", 4, "seq").collect()] == ["flagged", "big", "tie", "small"]


def test_top_rows_equals_a_full_sort(spark):
    df = spark.range(0, 5000, 1, 13).select(F.pmod(F.xxhash64("id"), F.lit(701)).alias("v"), "id")
    order = [F.col("v").desc(), F.col("id").asc()]
    expected = [tuple(r) for r in df.orderBy(*order).limit(1500).collect()]
    assert [tuple(r) for r in top_rows(df, order, 1500, groups=4).collect()] == expected
    plan = top_rows(df, order, 1500)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_limit_counts_only_new_rows(spark):
    df = frame(spark, [(f"u{i}", i) for i in range(10)], "url string, seq int")
    seen = frame(spark, [("u0",), ("u2",)], "url string")
    assert [r.url for r in limit_new(df, seen, "url", 3, "seq").collect()] == ["u1", "u3", "u4"]


def test_newest_first(spark):
    df = frame(spark, [("a", NOW), ("b", datetime(2026, 7, 20)), ("c", None)], "id string, at timestamp")
    assert [r.id for r in newest_first(df, "at", 2, "id").collect()] == ["b", "a"]


def test_first_success(spark):
    df = frame(spark, [("a", 2, "x"), ("a", 1, None), ("a", 3, "y"), ("b", 1, None)], "k string, rank int, v string")
    assert [tuple(r) for r in first_success(df, ["k"], "rank", F.col("v").isNotNull(), ["rank", "v"]).collect()] == [("a", 2, "x")]


def test_salted_lookup_equals_a_plain_join(spark):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    left = left.unionByName(frame(spark, [(None, -1), ("alone", -2)], "k string, id bigint"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    right = counts.where("k <> 'alone'").withColumn("v", F.length("k"))
    got = lookup(left, right, counts, "k", "n", F.col("id"), min_rows=100)
    plain = left.join(right.drop("n"), "k", "left")
    assert sorted(map(tuple, got.select("k", "id", "v").collect()), key=str) == sorted(map(tuple, plain.select("k", "id", "v").collect()), key=str)


def test_working_folder_needs_a_shared_place_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    import pytest

    from ledgerloom import session

    def fake(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default: folder, set=lambda key, value: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(fake(master))
        assert session.shared_folder(fake(master, "s3a://x/")) == "s3a://x"
    assert session.shared_folder(fake("local[4]")) and session.shared_folder(fake("local"))
