import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.plans import ingest
from ledgerloom.sinks.store import Store
from ledgerloom.sources import landed as L
from ledgerloom.sources.seeds import board_candidates, seed_names
from tests_support import AT

NOW = datetime(2026, 7, 19, 12)
NOW_COL = F.lit("2026-07-19T12:00:00Z").cast("timestamp")
NO_KEYS = "url string"


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def iso(hours):
    return (NOW - timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%SZ")


def test_dimensions(spark):
    assert seed_names(spark).count() == len(fv.SEED_NAMES)
    assert [tuple(r) for r in board_candidates(spark).where("company = 'OpenAI'").orderBy("rank").collect()] == [
        ("OpenAI", 0, "ashby", "openai"), ("OpenAI", 1, "greenhouse", "openai")]


def test_company_snapshot_and_startup_ingest(spark, tmp_path):
    companies = [
        {"name": "Obscure", "slug": "obscure", "team_size": 500},
        {"name": "Known", "slug": "known", "team_size": 5, "top_company": True},
        {"slug": "nameless", "team_size": 900},
        {"name": "Seen", "slug": "seen", "team_size": 800, "extra": 1},
        {"name": "Plain", "url": "https://plain.example"},
    ]
    path = put(tmp_path / "all.json", json.dumps(companies))
    rows = L.read_companies(spark, path)
    seen = spark.createDataFrame([("https://www.ycombinator.com/companies/seen",)], NO_KEYS)
    decided = {r.url.rsplit("/", 1)[-1]: r for r in ingest.startups(rows, seen, 4, AT).collect()}
    assert {k: r.outcome for k, r in decided.items()} == {"known": "saved", "seen": "already_seen", "obscure": "saved"}
    assert decided["known"].content.data.employeeCount == 5
    everything = ingest.startups(rows, seen, 10, AT)
    assert {r.content.entityName for r in ingest.saved_records(everything).collect()} == {"Obscure", "Known", "Plain"}
    assert ingest.rejections(everything, "STARTUP").count() == 0


def test_invalid_rows_are_reported_not_stored(spark, tmp_path):
    rows = L.read_companies(spark, put(tmp_path / "c.json", json.dumps([{"name": "Bad", "url": "nowhere"}, {"name": "Good", "slug": "g"}])))
    decided = ingest.startups(rows, spark.createDataFrame([], NO_KEYS), 9, AT)
    assert [(r.url, r.outcome, list(r.reject_reason)) for r in ingest.rejections(decided, "STARTUP").collect()] == [
        ("nowhere", "invalid", ["source.url is not a URL"])]
    store = Store(spark, str(tmp_path / "store"))
    assert ingest.commit(store, "STARTUP", 1, decided, AT) == 1
    assert [r.url for r in store.seen().collect()] == ["https://www.ycombinator.com/companies/g"]


def page(number, *nodes):
    info = {"hasNextPage": True, "endCursor": "c"}
    return json.dumps({"page": number, "data": {"posts": {"edges": [{"node": n} for n in nodes], "pageInfo": info}}})


def post(i, **fields):
    return {"id": str(i), "name": f"P{i}", "url": f"https://p.example/{i}", **fields}


def test_product_pages_and_ingest(spark, tmp_path):
    put(tmp_path / "b.json", page(2, post(5), post(6, name=None), {"name": "no url"}))
    put(tmp_path / "a.json", page(1, post(1, makers=[{"name": "Ann"}], tagline="A free tool"), post(2, makers=[{"name": ""}], description="Enterprise"),
                                  post(3, makers=[]), post(1, name="again")) + "\n" + page(3))
    posts = L.read_product_pages(spark, str(tmp_path / "*.json"))
    assert posts.count() == 7
    seen = spark.createDataFrame([("https://p.example/3",)], NO_KEYS)
    kept = {r.url[-1]: r for r in ingest.products(posts, seen, 3, AT).collect()}
    assert {k: (r.content.startupName, r.content.pricingModel, r.raw_text, r.copies) for k, r in kept.items()} == {
        "1": ("Ann", "FREE", "A free tool", 2), "2": ("P2", "ENTERPRISE", "Enterprise", 1), "5": ("P5", None, "", 1)}
    assert [r.url[-1] for r in ingest.products(posts, seen, 2, AT).orderBy("seq").collect()] == ["1", "2"]
    store = Store(spark, str(tmp_path / "store"))
    assert ingest.commit_products(store, 1, ingest.products(posts, seen, 3, AT), AT) == 3
    assert store.raw_text().where("raw_text = 'A free tool'").count() == 1
    assert sorted(r.url[-1] for r in store.seen().collect()) == ["1", "2", "5"]
    assert ingest.commit_products(store, 2, ingest.products(posts, store.seen(2), 9, AT), AT) == 1


def test_papers(spark, tmp_path):
    def paper(i, **fields):
        base = {"entry_id": f"http://arxiv.org/abs/{i}v1", "title": f" T{i} ", "authors": [{"name": "A"}, {"name": "B"}],
                "published": f"2026-07-{i:02d}T00:00:00Z", "summary": "s"}
        return {**base, **fields}
    lines = [paper(1), paper(12, comment="https://github.com/o/r."), paper(11), paper(10, summary="https://github.com/x/y", authors=[]), paper(9)]
    path = put(tmp_path / "papers.json", "\n".join(map(json.dumps, lines)))
    index = spark.createDataFrame([("11", '{"a": "https://github.com/i/i"}')], "paper_id string, payload string")
    stats = spark.createDataFrame([("o", "r", 5), ("i", "i", 0)], L.REPO_STATS)
    seen = spark.createDataFrame([("http://arxiv.org/abs/9v1",)], NO_KEYS)
    saved = ingest.saved_records(ingest.papers(L.read_papers(spark, path), seen, index, stats, 4, AT)).collect()
    assert {r.content.title: (r.content.github_url, r.content.github_stars, r.content.authors) for r in saved} == {
        "T12": ("https://github.com/o/r", 5, ["A", "B"]), "T11": ("https://github.com/i/i", 0, ["A", "B"]),
        "T10": ("https://github.com/x/y", None, [])}


RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>Feed</title>
<item><title>AI one</title><link>https://n.example/1</link><description>s &amp; t</description><pubDate>Sun, 19 Jul 2026 10:00:00 GMT</pubDate></item>
<item><title>Old AI</title><link> https://n.example/2 </link><pubDate>Sun, 12 Jul 2026 10:00:00 GMT</pubDate></item>
<item><title>Weather</title><link>https://n.example/3</link><description>rain</description></item>
<item><title>Undated</title><link>https://n.example/4</link><description>a chatbot</description></item>
<item><title>AI without link</title></item>
</channel></rss>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>
<entry><title type="html">LLM two</title><link rel="alternate" href="https://a.example/1"/><summary>x</summary><updated>2026-07-19T09:00:00Z</updated></entry>
<entry><title>LLM three</title><link href="https://n.example/1"/><published>2026-07-19T08:00:00Z</published><updated>2026-07-01T08:00:00Z</updated></entry>
</feed>"""


def feeds(spark, tmp_path):
    rss, atom = put(tmp_path / "rss.xml", RSS), put(tmp_path / "atom.xml", ATOM)
    return L.union_feeds({
        "First": lambda source: L.read_rss(spark, rss, source),
        "Gone": lambda source: L.read_rss(spark, str(tmp_path / "gone.xml"), source),
        "Second": L.read_atom(spark, atom, "Second"),
    })


def test_feed_union_skips_a_missing_feed(spark, tmp_path):
    rows = {(r.source, r.title): r for r in feeds(spark, tmp_path).collect()}
    assert len(rows) == 7
    assert rows["First", "AI one"].summary == "s & t" and rows["First", "Old AI"].link == "https://n.example/2"
    assert rows["Second", "LLM two"].link == "https://a.example/1" and rows["Second", "LLM three"].raw_date == "2026-07-19T08:00:00Z"


def test_feed_bodies(spark):
    landed = spark.createDataFrame([("First", RSS), ("Second", ATOM), ("Gone", None), ("Broken", "<rss><channel>")], "source string, body string")
    rows = L.feed_items(landed).collect()
    assert sorted((r.source, r.seq) for r in rows) == [("First", i) for i in range(5)] + [("Second", 0), ("Second", 1)]


def test_news_ingest(spark, tmp_path):
    items = feeds(spark, tmp_path).withColumn("seq", F.when(F.col("source") == "First", 0).otherwise(1))
    pages = spark.createDataFrame([("https://n.example/1", "<p>Body <b>text</b></p>"), ("https://n.example/2", "<p>old</p>")], "url string, html string")
    seen = spark.createDataFrame([], NO_KEYS)
    decided = {r.url: r for r in ingest.news(items, seen, pages, NOW_COL, AT, ["seq"]).collect()}
    assert {u: (r.outcome, r.copies) for u, r in decided.items()} == {
        "https://n.example/1": ("saved", 2), "https://n.example/2": ("stale", 1), "https://n.example/3": ("irrelevant", 1),
        "https://n.example/4": ("saved", 1), "https://a.example/1": ("saved", 1)}
    first = decided["https://n.example/1"]
    assert (first.source.name, first.content.fullText, first.content.publishedDate) == ("First", "Body text", datetime(2026, 7, 19, 10))
    assert decided["https://n.example/4"].content.publishedDate is None and decided["https://n.example/4"].content.fullText is None


def test_first_responding_board(spark):
    rows = [
        ("ashby", "openai", None, "404"), ("greenhouse", "openai", '{"jobs": []}', None),
        ("lever", "cohere", '{"ok": false}', None), ("greenhouse", "cohere", "[1]", None), ("ashby", "cohere", '{"jobs": [{"jobUrl": "u"}]}', None),
        ("greenhouse", "anthropic", "oops", None), ("lever", "scaleai", "[]", None), ("lever", "scale-ai", "[{}]", None),
    ]
    landed = spark.createDataFrame(rows, L.BOARD)
    found = {r.company: (r.platform, r.token) for r in L.first_boards(board_candidates(spark), landed).collect()}
    assert found == {"OpenAI": ("greenhouse", "openai"), "Cohere": ("ashby", "cohere"), "Scale AI": ("lever", "scaleai")}


def test_job_dialects_and_ingest(spark):
    fresh_ms = int((NOW - timedelta(hours=3) - datetime(1970, 1, 1)).total_seconds() * 1000)
    greenhouse = {"jobs": [
        {"absolute_url": "https://g/1", "updated_at": iso(5), "title": "Senior Software Engineer", "location": {"name": "Remote"}},
        {"absolute_url": "https://g/2", "updated_at": iso(120), "title": "Old Job"},
        {"absolute_url": "https://g/3", "title": "No date", "location": None}, {"title": "No link", "updated_at": iso(1)}]}
    lever = [{"hostedUrl": "https://l/1", "createdAt": fresh_ms, "text": "AI Research Scientist", "categories": {"location": "San Francisco (Remote)"}},
             {"hostedUrl": "https://l/2", "createdAt": 0, "text": "x"}, {"hostedUrl": "https://l/1", "createdAt": fresh_ms, "text": "again"}]
    ashby = {"jobs": [{"jobUrl": "https://a/1", "publishedAt": iso(4), "title": "Research Engineer", "isRemote": False, "location": "Remote"},
                      {"jobUrl": "", "applyUrl": "https://a/2", "publishedAt": "yesterday", "title": "Head of Sales"}]}
    rows = [("TestCo", "greenhouse", json.dumps(greenhouse)), ("LevCo", "lever", json.dumps(lever)), ("AshCo", "ashby", json.dumps(ashby)), ("Nope", "workable", "{}")]
    jobs = L.board_jobs(spark.createDataFrame(rows, "company string, platform string, body string"), NOW_COL)
    assert jobs.count() == 9
    seen = spark.createDataFrame([], NO_KEYS)
    decided = {r.url: r for r in ingest.jobs(jobs, seen, NOW_COL, AT).collect()}
    assert {u: (r.outcome, r.copies) for u, r in decided.items()} == {
        "https://g/1": ("saved", 1), "https://g/2": ("stale", 1), "https://g/3": ("dateless", 1), "https://l/1": ("saved", 2),
        "https://l/2": ("dateless", 1), "https://a/1": ("saved", 1), "https://a/2": ("saved", 1)}
    content = {u: (r.source.name, r.content.is_remote, r.content.role_family) for u, r in decided.items() if r.outcome == "saved"}
    assert content == {
        "https://g/1": ("TestCo (Greenhouse)", True, "Engineering"), "https://l/1": ("LevCo (Lever)", True, "Research"),
        "https://a/1": ("AshCo (Ashby)", False, "Engineering"), "https://a/2": ("AshCo (Ashby)", None, "Sales")}


def test_responses_file(spark, tmp_path):
    path = put(tmp_path / "r.json", json.dumps({"key": "a", "provider": "groq", "body": "{}", "seq": 3}))
    assert tuple(L.read_responses(spark, path).first()) == ("a", "groq", "{}", None, 3)


def test_payload_records(spark):
    def job(date):
        return json.dumps({"schemaVersion": "1.0", "recordType": "JOB", "source": {"name": "s", "url": "https://x"},
                           "content": {"company": "Co", "date": date, "is_remote": None, "role_family": "Sales"},
                           "collectedAt": "2026-07-19T12:00:00.123456+00:00"})
    rows = [("JOB", job("2026-07-19T10:00:00+02:00")), ("JOB", job("garbage")), ("NEWS", "{}")]
    found = L.payload_records(spark.createDataFrame(rows, "record_type string, payload string"), "JOB").collect()
    assert [(r.content.company, r.content.date, r.content.role_family) for r in found] == [
        ("Co", datetime(2026, 7, 19, 8), "Sales"), ("Co", None, "Sales")]
    assert found[0].collectedAt == datetime(2026, 7, 19, 12, 0, 0, 123456)


def test_feed_readers_are_lenient_and_account_for_losses(spark):
    bodies = [
        ("links", '<feed><entry><title>t</title><link rel="enclosure" href="https://f/1.mp3"/><link rel="alternate" href="https://f/1"/>'
                  "<content>body text</content></entry></feed>"),
        ("dates", "<rss><channel><item><title>d</title><link>https://f/2</link><dc:date>2026-07-19</dc:date></item></channel></rss>"),
        ("amp", "<rss><channel><item><title>a</title><link>https://f/3</link></item><item><title>b & c</title><link>https://f/4?x=1&y=2</link></item></channel></rss>"),
        ("cut", "<rss><channel><item><title>e</title><link>https://f/5</link></item><item><title>f"),
        ("bad", "<rss><channel><item><title>g</b></item><item><title>h</title><link>https://f/6</link></item></channel></rss>"),
        ("none", None), ("text", "no xml"), ("empty", "<rss><channel><title>x</title></channel></rss>"),
        ("cdata", "<rss><channel><item><title><![CDATA[a & b]]></title><link>https://f/7</link></item></channel></rss>"),
    ]
    landed_rows = spark.createDataFrame(bodies, "source string, body string")
    items = {(r.source, r.link): (r.title, r.summary, r.raw_date) for r in L.feed_items(landed_rows).collect()}
    assert items == {
        ("links", "https://f/1"): ("t", "body text", None), ("dates", "https://f/2"): ("d", None, "2026-07-19"),
        ("amp", "https://f/3"): ("a", None, None), ("amp", "https://f/4?x=1&y=2"): ("b & c", None, None),
        ("cut", "https://f/5"): ("e", None, None), ("bad", "https://f/6"): ("h", None, None), ("cdata", "https://f/7"): ("a & b", None, None),
    }
    lost = sorted((r.source, r.seq, r.reject_reason) for r in L.rejected_entries(landed_rows).collect())
    assert lost == [
        ("bad", 0, "unreadable entry"), ("cut", 1, "unreadable entry"), ("none", None, "no body"), ("text", None, "unreadable body"),
    ]


def test_null_job_list_is_no_answer(values):
    responded = L.board_responded(F.lit("ashby"), F.col("x"), F.lit(None).cast("string"))
    assert values(['{"jobs": null}', '{"jobs": []}', "{}", '{"jobs": 3}', "[]"], responded) == [False, True, True, False, False]


def test_nested_skipped_elements(values):
    from ledgerloom.functions.html import main_text

    assert values(["<nav><script>x</script>menu</nav><p>body</p>"], main_text(F.col("x"))) == ["body"]
