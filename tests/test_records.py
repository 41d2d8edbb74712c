import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import extract as X
from ledgerloom.operators import report as R
from ledgerloom.operators.lookups import fill_nulls, linked_repo, raw_text, repo_stars
from ledgerloom.operators.validate import CONTENT, envelope, split_records
from tests_support import AT, STAMP, chat, gemini, records

RESPONSE = "key string, provider string, body string, error string, seq bigint"


def fallback(spark, keys, rows):
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    tried = X.provider_fallback(frame, spark.createDataFrame(rows, RESPONSE), "key")
    return {r.key: r for r in tried.withColumn("data", F.col("data").cast("string")).collect()}


def test_first_provider_short_circuits(spark):
    rows = [("a", "gemini", gemini('{"title": "G"}'), None, 1), ("a", "groq", chat('{"title": "Q"}'), None, 1)]
    row = fallback(spark, ["a"], rows)["a"]
    assert (json.loads(row.data), row.provider_used, row.attempts) == ({"title": "G"}, "gemini", ["gemini: success"])


def test_fallback_through_failures(spark):
    rows = [("a", "gemini", None, "fail", 1), ("a", "groq", chat("Sure! Here's your data."), None, 1),
            ("a", "deepseek", chat('{"title": "D"}'), None, 1)]
    row = fallback(spark, ["a"], rows)["a"]
    assert row.provider_used == "deepseek"
    assert row.attempts == ["gemini: failed (fail)", "groq: returned unparseable JSON", "deepseek: success"]


def test_total_failure_and_missing_responses_keep_the_record(spark):
    rows = [("a", "gemini", None, "x", 1), ("a", "groq", '{"odd": 1}', None, 1), ("a", "deepseek", chat("[1]"), None, 1)]
    found = fallback(spark, ["a", "b"], rows)
    assert found["a"].data is None and found["a"].attempts[-1] == "all providers exhausted" and len(found["a"].attempts) == 4
    assert found["b"].provider_used is None and all("skipped" in m for m in found["b"].attempts[:3])


def test_only_one_provider_configured(spark):
    row = fallback(spark, ["a"], [("a", "groq", chat('{"title": "Groq only"}'), None, 1)])["a"]
    assert row.provider_used == "groq" and "skipped" in row.attempts[0]


def test_latest_response_counts(spark):
    rows = [("a", "gemini", gemini('{"v": 1}'), None, 1), ("a", "gemini", gemini('{"v": 2}'), None, 2), ("a", "other", "x", None, 9)]
    assert json.loads(fallback(spark, ["a"], rows)["a"].data) == {"v": 2}


def test_backfill_fills_only_open_rows_with_allowed_values(spark):
    rows = [("has", "FREE", "text"), ("fill", None, "text"), ("odd", None, "text"), ("blank", None, " "), ("none", None, None)]
    frame = spark.createDataFrame(rows, "key string, pricing string, text string")
    answers = [(k, "groq", chat(json.dumps({"pricingModel": v})), None, 1) for k, v in
               [("has", "PAID"), ("fill", " paid "), ("odd", "SUBSCRIPTION_BASED"), ("blank", "FREE"), ("none", "FREE")]]
    filled = X.enum_backfill(frame, spark.createDataFrame(answers, RESPONSE), "key", "pricing", "text", "pricingModel")
    assert {r.key: r.value for r in filled.collect()} == {"has": "FREE", "fill": "PAID", "odd": None, "blank": None, "none": None}
    assert tuple(X.backfill_report(filled, "pricing").first()) == (4, 1)


def test_enrichment_keeps_skipped_and_failed_rows(spark):
    news = spark.createDataFrame([("a", "text"), ("b", ""), ("c", None), ("d", "text")], "key string, text string")
    answers = spark.createDataFrame([("a", "gemini", gemini('{"summary": "s"}'), None, 1), ("b", "gemini", gemini("{}"), None, 1)], RESPONSE)
    log = X.enrichment_log(news, answers, "key", "text", AT)
    rows = {r.sourceUrl: r for r in log.collect()}
    assert rows["a"].providerUsed == "gemini" and rows["a"].enrichedAt == STAMP
    assert rows["b"].attempts == ["skipped: no full text available for this record"] and rows["b"].enrichedAt is None
    assert rows["c"].extraction is None and rows["d"].attempts[-1] == "all providers exhausted" and rows["d"].enrichedAt == STAMP
    assert tuple(X.enrichment_success(log).first()) == (4, 1)


def test_prompts_leave_out_blank_text(spark):
    frame = spark.createDataFrame([("a", "hello"), ("b", "  ")], "key string, text string")
    assert [r.key for r in X.prompts(frame, "key", "text", "S").collect()] == ["a"]


def test_star_lookup_miss_is_null(spark):
    papers = spark.createDataFrame(
        [(1, "https://github.com/a/b.git"), (2, "https://github.com/x/y"), (3, None), (4, "https://github.com/z/z")],
        "id int, github_url string")
    stats = spark.createDataFrame([("a", "b", 7), ("z", "z", 0)], "owner string, repo string, stargazers_count bigint")
    assert {r.id: r.github_stars for r in repo_stars(papers, stats, "github_url", "id").collect()} == {1: 7, 2: None, 3: None, 4: 0}


def test_linked_repo_order(spark):
    rows = [("http://x/1v1", "see https://github.com/c/c", "https://github.com/s/s"), ("http://x/2v3", "see https://github.com/c/c.", "s"),
            ("http://x/3", None, "at https://github.com/s/s"), ("http://x/4", None, None)]
    papers = spark.createDataFrame(rows, "entry_id string, comment string, summary string")
    index = spark.createDataFrame([("1", '{"deep": {"any": "https://github.com/i/i"}}'), ("2", '{"nothing": 1}')], "paper_id string, payload string")
    found = {r.entry_id: r.github_url for r in linked_repo(papers, index, "entry_id", "comment", "summary").collect()}
    assert found == {"http://x/1v1": "https://github.com/i/i", "http://x/2v3": "https://github.com/c/c", "http://x/3": "https://github.com/s/s", "http://x/4": None}


def test_raw_text_joins_on_the_canonical_url(spark):
    left = spark.createDataFrame([("https://A.example",), ("https://b.example/x",)], "url string")
    texts = spark.createDataFrame([("https://a.example/", "t")], "url string, raw_text string")
    assert {r.url: r.raw_text for r in raw_text(left, texts, "url").collect()} == {"https://A.example": "t", "https://b.example/x": None}


def test_fill_nulls(spark):
    frame = spark.createDataFrame([("old", "new"), (None, "new"), (None, None)], "o string, n string")
    assert [r[0] for r in frame.select(fill_nulls(F.col("o"), F.col("n"))).collect()] == ["old", "new", None]


def test_envelope_fields(spark):
    row = spark.range(1).select(*envelope("STARTUP", F.lit("src"), F.lit("https://x.example"), F.struct(
        F.lit("Acme").alias("entityName"), F.struct(F.lit(3).alias("employeeCount")).alias("data")), AT)).first()
    assert (row.schemaVersion, row.recordType, row.source.url, row.content.data.employeeCount, row.collectedAt) == (
        "1.0", "STARTUP", "https://x.example", 3, STAMP)


@pytest.mark.parametrize("kind,good,bad", [
    ("STARTUP", ("A", (None,)), (None, (1,))),
    ("PRODUCT", ("A", "FREE"), ("A", "CHEAP")),
    ("PRODUCT", ("A", None), (None, None)),
    ("RESEARCH_PAPER", ("T", [], "https://x.example/1", None, None, None), ("T", [], "nowhere", None, None, None)),
    ("RESEARCH_PAPER", ("T", ["A"], "https://x.example/1", "https://github.com/a/b", 1, STAMP), (None, [], "https://x.example/1", "bad", None, None)),
    ("JOB", ("Co", None, None, None), (None, None, None, None)),
])
def test_invalid_records_are_split_off_with_reasons(spark, kind, good, bad):
    df = records(spark, kind, [(("s", "https://x.example/1"), good), (("s", "https://x.example/2"), bad), (("s", "not a url"), good)])
    valid, rejected = split_records(df, kind)
    assert [r.source.url for r in valid.collect()] == ["https://x.example/1"]
    assert {r.source.url: len(r.reject_reason) > 0 for r in rejected.collect()} == {"https://x.example/2": True, "not a url": True}


def test_every_type_has_a_schema(spark):
    for kind in CONTENT:
        assert records(spark, kind, []).columns == ["schemaVersion", "recordType", "source", "content", "collectedAt"]


def test_count_by_type_fills_zeros(spark):
    df = spark.createDataFrame([("JOB",), ("JOB",), ("NEWS",)], "record_type string")
    assert {r.record_type: r.n for r in R.count_by_type(df).collect()} == {
        "STARTUP": 0, "PRODUCT": 0, "RESEARCH_PAPER": 0, "JOB": 2, "NEWS": 1}


def test_summary_uses_truthiness(spark):
    url = ("s", "https://x.example")
    paper = lambda stars: (url, ("T", [], "https://x.example", None, stars, None))
    mappings = spark.createDataFrame([("a", "a", 0.0), ("b", "B", 1.0), ("c", "c", None)], "raw_name string, canonical_name string, confidence double")
    row = R.summary(
        records(spark, "STARTUP", [(url, ("A", (1,)))]), records(spark, "PRODUCT", [(url, ("A", "FREE")), (url, ("B", None)), (url, ("C", ""))]),
        records(spark, "RESEARCH_PAPER", [paper(0), paper(5), paper(None)]), records(spark, "JOB", []), records(spark, "NEWS", []), mappings).first()
    assert row.asDict() == {"startups": 1, "products": 3, "papers": 3, "papersWithGithubStars": 1, "jobs": 0, "news": 0,
                            "productsWithPricing": 1, "entityMappingsResolved": 1, "entityMappingsTotal": 3}


def test_category_counts(spark):
    df = spark.createDataFrame([("PAID",)] * 3 + [("FREE",)] * 2 + [(None,), ("",)], "pricing string")
    assert [tuple(r) for r in R.category_counts(df, "pricing").collect()] == [("PAID", 3, 100), ("FREE", 2, 67), ("Unclassified", 2, 67)]


def test_search_and_label(spark):
    df = records(spark, "JOB", [(("s", "https://x/1"), ("OpenAI", None, None, "Engineering")), (("s", "https://x/2"), (None, None, None, "Sales"))])
    assert R.search(df, "JOB", "ENGIN").count() == 1 and R.search(df, "JOB", "").count() == 2
    found = R.matched_of_total(df, R.search_predicate("openai", *R.search_columns()["JOB"])).first()
    assert tuple(found) == (1, 2, "1 of 2")


def test_mapping_views(spark):
    rows = [("a", "A", 0.95), ("b", "b", 1.0), ("c", "C", 0.91), ("d", "d", 0.0)]
    df = spark.createDataFrame(rows, "raw_name string, canonical_name string, confidence double")
    assert [r.raw_name for r in R.by_confidence(df).collect()] == ["b", "a", "c", "d"]
    assert [r.raw_name for r in R.review_list(df, 1).collect()] == ["c"]
    assert {r.raw_name for r in R.resolved_mappings(df).collect()} == {"a", "b", "c"}


def test_flat_rows(spark):
    paper = records(spark, "RESEARCH_PAPER", [(("Arxiv", "https://x"), ("T", ["Alice", "Bob"], "https://x", None, 0, None))])
    row = paper.select(*R.flat_columns("RESEARCH_PAPER")).first()
    assert tuple(row) == ("1.0", "RESEARCH_PAPER", "Arxiv", "https://x", "T", "Alice, Bob", "https://x", "", "0", "", "2026-07-19T12:00:00Z")
    job = records(spark, "JOB", [((None, "https://x"), ("Co", STAMP, False, None))]).select(*R.flat_columns("JOB")).first()
    assert tuple(job)[2:8] == ("", "https://x", "Co", "2026-07-19T12:00:00Z", "false", "")
    news = records(spark, "NEWS", [(("f", "https://x"), ("T", None, "x" * 6000))]).select(*R.flat_columns("NEWS")).first()
    assert news["fullText"].endswith("[truncated]") and len(news["fullText"]) == 5000 + len("... [truncated]")


def test_display_values(spark, values):
    x = F.col("x")
    assert values(["FREE", "FREEMIUM", "PAID", "", None], R.pricing_badge(x)) == ["free", "free", "paid", "—", "—"]
    assert values([["a", "b", "c", "d"], ["a", "b"], [], None], R.short_authors(x), "array<string>") == ["a, b +2", "a, b", "", ""]
    assert values([True, False, None], R.yes_no(x), "boolean") == ["Yes", "No", "—"]
    assert values([0.941, 1.0, None], R.two_decimals(x), "double") == ["0.94", "1.00", "—"]
    assert values([STAMP, None], R.minute_text(x), "timestamp") == ["2026-07-19 12:00", ""]
