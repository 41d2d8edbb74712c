"""Streams on a state store, the batch log, pushed seen keys, typed payloads, dense page text and page order."""

import glob
import json
import os
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.html import TAG_COST, TOKENS, dense_text, densest_run
from ledgerloom.operators.page_order import page_places
from ledgerloom.operators.typed import judge_payloads, typed_records
from ledgerloom.sinks.batch_log import BatchLog
from ledgerloom.sinks.store import Store
from ledgerloom.sources.landed import read_product_pages
from ledgerloom.streaming.keyed import first_in_batch, ingest_keyed, seen_keys
from tests_support import AT, STAMP, records

NOW = datetime(2026, 7, 19, 12)
NOW_COL = F.lit("2026-07-19T12:00:00Z").cast("timestamp")
ROW = "url string, seq bigint, published timestamp"


def land(spark, path, *rows):
    spark.createDataFrame(list(rows), ROW).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, root, **options):
    log = BatchLog(spark, f"{root}/saved", ROW)
    stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(path)
    ingest_keyed(stream, log, "url", ["seq"], f"{root}/checkpoint", **options).trigger(availableNow=True).start().awaitTermination()
    return log


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    land(spark, path, ("a", 2, NOW), ("a", 1, NOW), ("b", 3, NOW - timedelta(days=5)))
    land(spark, path, ("b", 4, NOW), ("c", 5, None), ("a", 6, NOW))
    land(spark, path, ("d", 7, NOW - timedelta(hours=24)), (None, 8, NOW), ("c", 9, NOW))
    return path


def saved(log):
    return sorted((r.url, r.seq) for r in log.read().collect())


def keys(spark, root):
    return sorted(r.url for r in seen_keys(spark, f"{root}/checkpoint", "url").collect())


def test_keyed_first_row_and_restart(spark, landing, tmp_path):
    root = str(tmp_path / "run")
    assert saved(run(spark, landing, root)) == [("a", 1), ("b", 3), ("c", 5), ("d", 7)]
    assert keys(spark, root) == ["a", "b", "c", "d"]
    land(spark, landing, ("a", 10, NOW), ("e", 12, NOW), ("e", 11, NOW))
    assert saved(run(spark, landing, root)) == [("a", 1), ("b", 3), ("c", 5), ("d", 7), ("e", 11)]


def test_keyed_rejections(spark, landing, tmp_path):
    marked, free = str(tmp_path / "marked"), str(tmp_path / "free")
    assert saved(run(spark, landing, marked, now=NOW_COL, ts="published")) == [("a", 1), ("c", 5), ("d", 7)]
    assert keys(spark, marked) == ["a", "b", "c", "d"]
    assert saved(run(spark, landing, free, now=NOW_COL, ts="published", dateless="drop", mark_rejected=False)) == [("a", 1), ("b", 4), ("c", 9), ("d", 7)]


def test_a_replayed_batch_saves_nothing_twice(spark, landing, tmp_path):
    """The last commit is lost, as when the driver dies between writing and committing: the batch runs again from the state before it."""
    root = str(tmp_path / "run")
    before = saved(run(spark, landing, root))
    last = max(glob.glob(f"{root}/checkpoint/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    for crc in glob.glob(f"{root}/checkpoint/commits/.*.crc"):
        os.remove(crc)
    assert saved(run(spark, landing, root)) == before and keys(spark, root) == ["a", "b", "c", "d"]


def test_many_small_batches_keep_few_files(spark, tmp_path):
    root, path = str(tmp_path / "run"), str(tmp_path / "landing")
    spark.range(0, 140).select(F.concat(F.lit("k"), (F.col("id") % 100).cast("string")).alias("url"), F.col("id").alias("seq"), NOW_COL.alias("published")).repartition(70).write.parquet(path)
    log = run(spark, path, root)
    rows = saved(log)
    assert len(rows) == 100 and len({u for u, _ in rows}) == 100
    assert log.read().select("batch_id").distinct().count() > 50
    assert len(log.ranges()) < 45 and (0, 31) in log.ranges() and (32, 63) in log.ranges()
    assert len([f for f in glob.glob(f"{root}/checkpoint/commits/[0-9]*")]) < 40
    assert not glob.glob(f"{root}/**/seen*", recursive=True)


def test_first_in_batch(spark):
    rows = [("b", 3, "x"), ("a", 2, "y"), (None, 0, "n"), ("a", 1, "z"), ("b", 5, None), ("c", None, "q")]
    df = spark.createDataFrame(rows, "k string, s long, v string").repartition(3)
    assert sorted(tuple(r) for r in first_in_batch(df, "k", ["s"]).collect()) == [("a", 1, "z"), ("b", 3, "x"), ("c", None, "q")]
    assert first_in_batch(df.limit(0), "k", ["s"]).count() == 0


def test_batch_log_merges_and_replaces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerloom.sinks.batch_log.FANOUT", 3)
    log = BatchLog(spark, str(tmp_path / "log"), "k string")
    assert log.read().count() == 0
    for batch in range(11):
        for _ in range(2):  # each batch is repeated
            log.write(spark.createDataFrame([(f"k{batch}",)] * (batch % 2 + 1), "k string"), batch)
    assert log.ranges() == [(0, 8), (9, 9), (10, 10)]
    rows = sorted((r.batch_id, r.k) for r in log.read().collect())
    assert rows == sorted((b, f"k{b}") for b in range(11) for _ in range(b % 2 + 1))
    spark.createDataFrame([("old", 1)], "k string, batch_id bigint").write.parquet(f"{log.root}/1-1")  # left over by a merge that died before its deletions
    assert sorted((r.batch_id, r.k) for r in log.read().collect()) == rows


def scans(df):
    """Files and rows that the file scans of a query read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    found, open_ = [], [plan]
    while open_:
        node = open_.pop()
        if node.nodeName().startswith("Scan parquet"):
            metrics = node.metrics()
            found.append(tuple(metrics.apply(name).value() for name in ("numFiles", "numOutputRows")))
        if "QueryStage" in node.nodeName():
            open_.append(node.plan())
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return found


def test_few_keys_read_few_rows_of_many(spark, tmp_path):
    """100 keys against ten million: the buckets' files, and in them the row groups and pages that may hold a key."""
    store = Store(spark, str(tmp_path / "store"))
    many = spark.range(0, 10_000_000, 1, 16).selectExpr("concat('https://x.example/', sha2(cast(id as string), 224)) url")
    store._mark(many.withColumn("first_seen_at", AT), "NEWS", 1)
    store._mark(many.limit(10).withColumn("first_seen_at", AT), "JOB", 2)
    new = spark.range(100).selectExpr("concat('https://x.example/', sha2(cast(-1 - id as string), 224)) url")
    old = spark.range(5_000_000, 5_000_100).selectExpr("concat('https://x.example/', sha2(cast(id as string), 224)) url")
    whole = store.seen()
    assert sum(rows for _, rows in scans(whole.agg(F.count("url")))) == 10_000_010
    unseen = store.seen(9, "NEWS", new)
    [(files, rows)] = scans(unseen)
    assert unseen.count() == 0 and files <= 74 and rows < 100_000
    found = store.seen(9, "NEWS", old)
    [(files, rows)] = scans(found)
    assert found.count() == 100 and rows < 600_000
    few = store.seen(9, "NEWS", old.limit(3))
    [(files, rows)] = scans(few)
    assert few.count() == 3 and files <= 4 and rows < 30_000
    assert sorted(r.url for r in few.collect()) == sorted(r.url for r in old.limit(3).collect())
    small = sum(os.path.getsize(f) for f in glob.glob(f"{store.root}/seen/record_type=JOB/**/*.parquet", recursive=True))
    assert small < 200_000  # a filter is no larger than its keys need


def test_seen_with_more_keys_than_are_pushed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    urls = lambda a, b: spark.range(a, b).selectExpr("concat('https://x/', id) url")
    store._mark(urls(0, 3000).withColumn("first_seen_at", AT), "NEWS", 1)
    for batch in (urls(2500, 3500), urls(2990, 3010), urls(0, 0), urls(0, 1).selectExpr("cast(null as string) url")):
        hits = store.seen(keys=batch).join(batch, "url", "left_semi").count()
        assert hits == batch.selectExpr("cast(substr(url, 11) as int) n").where("n < 3000").count()


def test_commit_counts_saved_rows_as_they_are_written(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    news = records(spark, "NEWS", [(("f", f"https://x/{i}"), ("T", None, None)) for i in range(7)]).repartition(3)
    none = spark.createDataFrame([], "url string")
    assert store.commit("NEWS", 1, news, none, AT) == 7 and store.commit("NEWS", 2, news.limit(0), none, AT) == 0


def wrap(content, **others):
    return json.dumps({"source": {"name": "s", "url": "https://x.example/1"}, "content": content} | others)


@pytest.mark.parametrize("kind,payload,faults", [
    ("STARTUP", wrap({"entityName": "A", "data": {"employeeCount": "many"}}), [("$.content.data.employeeCount", "not a whole number")]),
    ("STARTUP", wrap({"entityName": "A"}), []),
    ("STARTUP", wrap({"entityName": "A", "data": []}), [("$.content.data", "not an object")]),
    ("STARTUP", wrap({"data": {"employeeCount": 10**30}}), [("$.content.entityName", "missing"), ("$.content.data.employeeCount", "not a whole number")]),
    ("JOB", wrap({"company": "C", "is_remote": 5}), [("$.content.is_remote", "not true or false")]),
    ("JOB", wrap({"company": 5, "is_remote": "off", "role_family": True}), [("$.content.company", "not a text"), ("$.content.role_family", "not a text")]),
    ("JOB", wrap({"company": "C", "date": "2024-02-30T00:00:00Z"}), [("$.content.date", "not an ISO time")]),
    ("PRODUCT", wrap({"startupName": "", "pricingModel": "FREE"}), []),
    ("PRODUCT", wrap({"startupName": "P", "pricingModel": "free"}), [("$.content.pricingModel", "not an allowed value")]),
    ("RESEARCH_PAPER", wrap({"title": "T", "paper_url": "x", "authors": ["A", None], "github_url": None, "github_stars": "7"}),
     [("$.content.authors", "not a list of texts"), ("$.content.paper_url", "not a URL")]),
    ("NEWS", wrap({"title": None, "fullText": 1}, schemaVersion=1, collectedAt=None),
     [("$.schemaVersion", "not a text"), ("$.collectedAt", "not an ISO time"), ("$.content.title", "missing"), ("$.content.fullText", "not a text")]),
    ("NEWS", '{"content": {"title": "T"}}', [("$.source", "missing")]),
    ("NEWS", '{"source": 5, "content": "x"}', [("$.source", "not an object"), ("$.content", "not an object")]),
    ("NEWS", wrap({"title": "T"})[:-1], [("$", "broken JSON")]),
    ("NEWS", None, [("$", "broken JSON")]),
    ("NEWS", "[1]", [("$", "not an object")]),
    ("NEWS", "", [("$", "broken JSON")]),
])
def test_payload_faults(spark, kind, payload, faults):
    judged = judge_payloads(spark.createDataFrame([(1, payload, "kept")], "id int, payload string, rejects_before string"), kind).first()
    assert [tuple(r) for r in judged.rejects] == faults
    assert (judged.record is None) == bool(faults) and judged.rejects_before == "kept"


def test_typed_values(spark):
    rows = [wrap({"title": "T", "paper_url": "https://p.example", "github_stars": " 12.0 ", "published_date": "2024-01-02T05:04:00+02:00"}, collectedAt="2026-07-19T12:00:00Z")]
    rows += [wrap({"title": "T", "paper_url": "https://p.example", "authors": ["A", "B"], "github_stars": True}), "broken"]
    judged = judge_payloads(spark.createDataFrame([(r,) for r in rows], "payload string"), "RESEARCH_PAPER")
    first, second = typed_records(judged).orderBy(F.col("collectedAt").desc_nulls_last()).collect()
    assert (first.schemaVersion, first.recordType, first.collectedAt, first.content.authors, first.content.github_stars) == ("1.0", "RESEARCH_PAPER", STAMP, [], 12)
    assert first.content.published_date == datetime(2024, 1, 2, 3, 4) and (second.content.authors, second.content.github_stars, second.collectedAt) == (["A", "B"], 1, None)
    with pytest.raises(ValueError):
        judge_payloads(judged, "OTHER")


def plain_dense(html):
    tokens = [m.group(0) for m in re.finditer(TOKENS, html)]
    word = [t[0] != "<" or t == "<" for t in tokens]
    gains = [1 if w else -TAG_COST for w in word]
    best, place = 0, None
    for end in range(1, len(gains) + 1):
        total = 0
        for start in range(end - 1, -1, -1):
            total += gains[start]
            if total > best:
                best, place = total, (start, end)
    if place is None:
        return None
    return " ".join(t for t, w in zip(tokens[place[0] : place[1]], word[place[0] : place[1]]) if w)


def test_dense_text_equals_all_runs(spark, values):
    rng = random.Random(5)
    parts = ["<p>", "</p>", "word", "two words", "<b>x</b>", "<", "a<5", "<!-- c <p> -->", "<script>if (a<b) {}</script>", "<STYLE>p{}</STYLE >", "<br/>", "\n", "&x;", "é"]
    pages = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(150)]
    assert values(pages, dense_text(F.col("x"))) == [plain_dense(p) for p in pages]
    assert values([None, "", "<p></p>", "only words"], dense_text(F.col("x"))) == [None, None, None, "only words"]


def test_dense_text_of_a_page_without_article(values):
    menu = "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(30))
    body = "".join(f"<p>Paragraph {i} tells &amp; explains what the page is about in a dozen of words or so.</p>" for i in range(6))
    page = f"<html><head><title>t</title><script>var a = 'x y z';</script></head><body><ul>{menu}</ul><div><h1>Head</h1>{body}</div><ul>{menu}</ul></body></html>"
    [text] = values([page], dense_text(F.col("x")))
    assert text.startswith("Paragraph 0 tells & explains") and text.endswith("words or so.") and "Item" not in text and "var" not in text
    assert values([[1, -5, 2, 2, -1, 2, -9, 5]], densest_run(F.col("x")), "array<int>")[0] == (2, 4)


def test_page_places(spark):
    rng = random.Random(3)
    cursor = lambda f, n: None if n == 0 else f"{f}-{n * 7919 % 1000}"
    rows = [("long", cursor("long", n), cursor("long", n + 1), n < 199, n) for n in range(200)]
    rows += [("gap", cursor("gap", n), cursor("gap", n + 1), True, n) for n in (0, 1, 3, 4)]
    rows += [("round", "r1", "r2", True, 1), ("round", "r2", "r3", True, 2), ("round", "r3", "r1", True, 3), ("round", "self", "self", True, 4)]
    rows += [("one", "", "x", None, 0), (None, None, "n2", True, 0), (None, "n2", None, True, 1), ("long", cursor("long", 5), cursor("long", 6), True, 5)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "feed string, cursor string, end_cursor string, has_next boolean, n int")
    found = {(r.feed, r.cursor): (r.page, r.status) for r in page_places(df.where("feed IS NOT NULL")).collect()}
    expected = {("long", cursor("long", n) or ""): (n, "ordered") for n in range(200)}
    expected |= {("gap", ""): (0, "ordered"), ("gap", cursor("gap", 1)): (1, "ordered"), ("gap", cursor("gap", 3)): (0, "break"), ("gap", cursor("gap", 4)): (1, "break")}
    expected |= {("round", c): (None, "cycle") for c in ("r1", "r2", "r3", "self")} | {("one", ""): (0, "ordered")}
    assert found == expected
    assert page_places(df.limit(0)).count() == 0


def test_product_pages_by_cursor(spark, tmp_path):
    def page(cursor, following, *names):
        edges = [{"node": {"id": n, "name": n}} for n in names]
        return json.dumps({"cursor": cursor, "data": {"posts": {"edges": edges, "pageInfo": {"hasNextPage": following is not None, "endCursor": following}}}})

    lines = [page("b", "c", "3", "4"), page(None, "b", "1", "2"), page("c", None, "5"), page("z", None, "9"), page("b", "c", "3", "4")]
    (tmp_path / "pages.jsonl").write_text("\n".join(lines))
    posts = read_product_pages(spark, str(tmp_path), by_cursor=True).orderBy("seq").collect()
    assert [p.id for p in posts] == ["1", "2", "3", "4", "5", "9"]


def test_unreadable_dates_are_reported_and_come_again(spark):
    from ledgerloom.operators.ingest import keys_to_mark
    from ledgerloom.plans import ingest
    from ledgerloom.sources.landed import board_jobs

    ashby = {"jobs": [
        {"jobUrl": "https://a/1", "publishedAt": "the day of the launch", "title": "x"}, {"jobUrl": "https://a/2", "publishedAt": " ", "title": "x"},
        {"jobUrl": "https://a/3", "title": "x"}, {"jobUrl": "https://a/4", "publishedAt": "2 hours ago", "title": "x"}]}
    lever = [{"hostedUrl": "https://l/1", "createdAt": 0, "text": "x"}]
    boards = spark.createDataFrame([("A", "ashby", json.dumps(ashby)), ("L", "lever", json.dumps(lever))], "company string, platform string, body string")
    decided = ingest.jobs(board_jobs(boards, NOW_COL), spark.createDataFrame([], "url string"), NOW_COL, AT)
    assert {r.url[8:]: r.outcome for r in decided.collect()} == {"a/1": "unreadable_date", "a/2": "dateless", "a/3": "dateless", "a/4": "saved", "l/1": "dateless"}
    assert sorted(r.url[8:] for r in keys_to_mark(decided, "url", True).collect()) == ["a/2", "a/3", "a/4", "l/1"]
    rejected = {r.url[8:]: r.outcome for r in ingest.rejections(decided, "JOB").collect()}
    assert rejected["a/1"] == "unreadable_date"


def test_updates_are_compacted(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.append_records(records(spark, "PRODUCT", [(("s", f"https://x/{i}"), (f"P{i}", None)) for i in range(3)]), "PRODUCT", 1)
    update = lambda *rows: spark.createDataFrame(list(rows), "url string, content struct<startupName:string,pricingModel:string>")
    current = lambda: sorted((r.content.startupName, r.content.pricingModel) for r in store.current("PRODUCT").collect())
    store.append_updates(update(("https://x/0", ("P0", "FREE")), ("https://x/1", ("P1", "PAID"))), "PRODUCT", 2)
    store.append_updates(update(("https://x/0", ("P0", "PAID"))), "PRODUCT", 3)
    before = current()
    assert before == [("P0", "PAID"), ("P1", "PAID"), ("P2", None)]
    store.compact_updates("PRODUCT", 3)
    assert current() == before and not glob.glob(f"{store.root}/updates/record_type=PRODUCT/batch_id=*") and store._all_updates("PRODUCT").count() == 2
    store.append_updates(update(("https://x/0", ("P0", "ENTERPRISE"))), "PRODUCT", 3)  # the merged batch runs again
    assert current() == [("P0", "ENTERPRISE"), ("P1", "PAID"), ("P2", None)]
    store.compact_updates("PRODUCT", 3)
    store.append_updates(update(("https://x/2", ("P2", "FREE"))), "PRODUCT", 4)
    assert current() == [("P0", "ENTERPRISE"), ("P1", "PAID"), ("P2", "FREE")]


def test_numbers_without_one_task(spark):
    from ledgerloom.operators.ranking import numbered

    df = spark.range(0, 5000, 1, 7).selectExpr("id", "pmod(id * 7919, 5000) v")
    out = numbered(df, [F.col("v").desc(), F.col("id")])
    assert [(r.number, r.v) for r in out.orderBy("number").collect()] == [(i + 1, 4999 - i) for i in range(5000)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString() and numbered(df.limit(0), [F.col("v")]).count() == 0


def test_search_through_grams_equals_a_scan(spark, tmp_path):
    from ledgerloom.operators.gram_index import GramIndex
    from ledgerloom.operators.report import search_predicate

    rng = random.Random(8)
    words = ["Alpha", "alphabet", "beta", "Ünïcode", "naïve", "ab", "", "gamma ray", "RAY", "100%"]
    rows = [(f"k{i % 900}" if i % 50 else None, " ".join(rng.choices(words, k=rng.randrange(4))), rng.choice([None, *words])) for i in range(1000)]
    df = spark.createDataFrame(rows, "url string, title string, note string")
    index = GramIndex(spark, str(tmp_path / "index"), {"title": F.col("title"), "note": F.col("note")}).build(df, "url")
    for query in ("alpha", "ALPHAB", "ma r", "ünï", "ray", "a", "", "zzz", "beta alpha", "100%", "naïve"):
        expected = df.where(search_predicate(query, F.col("title"), F.col("note"))).selectExpr("coalesce(url, '') key", "title", "note")
        found = index.search(query)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect())), query
    assert index.candidates("zzz").count() == 0 and index.candidates("ab") is None
    assert index.candidates("ünïcode").count() < 500  # fewer keys than rows


def test_feed_files_and_stream(spark, tmp_path):
    from ledgerloom.sources.landed import read_atom, read_rss, rejected_file_entries, stream_feed

    landing, done = tmp_path / "landing", tmp_path / "done"
    landing.mkdir()
    item = lambda t: f"<item><title>{t}</title><link> https://x/{t[:1]} </link></item>"
    (landing / "a.xml").write_text(f"<rss><channel>{item('a &amp; b')}{item('c & d')}{item('e <b f')}{item('g')}<item><title>cut")
    (landing / "b.xml").write_text(f"<rss><channel>\n{item('h')}\n</channel></rss>")
    found = read_rss(spark, str(landing), "S").collect()
    assert sorted(r.title for r in found if r.title) == ["a & b", "c & d", "g", "h"] and {r.source for r in found} == {"S"}
    lost = {(os.path.basename(r.file), r.reject_reason): r.n for r in rejected_file_entries(spark, str(landing), "S", "rss").collect()}
    assert lost == {("a.xml", "unreadable entry"): 1, ("a.xml", "cut-off entry"): 1}
    (tmp_path / "atom.xml").write_text('<feed><entry><title>t</title><link rel="alternate" href="https://x/t"/><updated>2024</updated></entry></feed>')
    assert [(r.title, r.link, r.raw_date) for r in read_atom(spark, str(tmp_path / "atom.xml"), "A").collect()] == [("t", "https://x/t", "2024")]
    items = stream_feed(spark, str(landing), "S", "rss", str(done))
    for _ in range(2):
        writer = items.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.title for r in spark.read.parquet(str(tmp_path / "rows")).collect() if r.title) == ["a & b", "c & d", "g", "h"]
