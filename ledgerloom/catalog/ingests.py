"""Queries over dedup, seen keys, ranking, validation, lookups and the ingest jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.catalog.dated import events, latest_event
from ledgerloom.catalog.tables import sql_text, table, text_of, utc
from ledgerloom.functions.dates import is_fresh
from ledgerloom.functions.text import first_non_empty, source_label
from ledgerloom.functions.urls import company_profile_url
from ledgerloom.operators.dedup import (
    exclude_seen,
    exclude_seen_small_batch,
    first_per_key,
    latest_per_key,
    new_seen_keys,
    require,
)
from ledgerloom.operators.ingest import accounting, decide, freshness_reason
from ledgerloom.operators.lookups import linked_repo, repo_stars
from ledgerloom.operators.page_order import page_places
from ledgerloom.operators.ranking import first_success, limit_new, newest_first, prominence_topk
from ledgerloom.operators.validate import envelope, split_valid
from ledgerloom.plans import ingest
from ledgerloom.session import run_folder
from ledgerloom.sources.landed import POST_PAGE, board_jobs, first_boards, product_posts, read_papers, read_product_pages

HALF = "2024-01-16T00:00:00Z"
AT = "2024-02-01T00:00:00Z"


def keyed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a key that repeats: user, kind and payload."""
    return events(spark, sf).withColumn("url", F.concat_ws(":", "user_id", "event_type", "props"))


def halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Keys of the first half as seen, and the events of the second half."""
    rows = keyed_events(spark, sf)
    return rows.where(F.col("ts") < utc(HALF)).select("url").distinct(), rows.where(F.col("ts") >= utc(HALF))


def seen_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    seen, new = halves(spark, sf)
    return exclude_seen(first_per_key(new, ["url"], "event_id"), seen, "url").select("url", "event_id")


def seen_small_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The same exclusion, planned for a batch far smaller than the seen table."""
    seen, new = halves(spark, sf)
    return exclude_seen_small_batch(first_per_key(new, ["url"], "event_id"), seen, "url").select("url", "event_id")


def seen_key_rows(spark: SparkSession, sf: str) -> DataFrame:
    seen, new = halves(spark, sf)
    rows = new_seen_keys(new, seen, "url", "NEWS", utc(AT))
    return rows.select("url", "record_type", text_of(F.col("first_seen_at")).alias("first_seen_at"))


def ingest_accounting(spark: SparkSession, sf: str) -> DataFrame:
    seen, new = halves(spark, sf)
    now = latest_event(spark, sf)
    dated = new.select("url", "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("published"))
    reason = freshness_reason(F.col("published"), now, "drop")
    return accounting(decide(dated, seen, "url", ["event_id"], reason))


def validate_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    rules = [
        F.when(F.col("quality").isNull(), F.lit("quality is missing")),
        F.when(~F.col("lang").isin("en", "fr", "de"), F.lit("lang is not allowed")),
        F.when(~F.coalesce(F.col("source"), F.lit("")).rlike(r"^src\d$"), F.lit("source is not a source")),
    ]
    valid, rejected = split_valid(rows, rules, once=False)
    return valid.select("doc_id", F.lit("").alias("reasons")).unionByName(
        rejected.select("doc_id", F.array_join("reject_reason", "; ").alias("reasons"))
    )


def prominence(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").withColumn("top", F.col("c_mktsegment") == "BUILDING")
    return prominence_topk(rows, "top", "c_acctbal", 100, "c_custkey").select("c_custkey", "c_name")


def limit_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return limit_new(table(spark, sf, "orders"), seen, "o_custkey", 1000, "o_orderkey").select("o_orderkey", "o_custkey")


def newest(spark: SparkSession, sf: str) -> DataFrame:
    top = newest_first(table(spark, sf, "orders"), "o_orderdate", 500, "o_orderkey")
    return top.select("o_orderkey", text_of(F.col("o_orderdate")).alias("o_orderdate"))


def latest_orders(spark: SparkSession, sf: str) -> DataFrame:
    latest = latest_per_key(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey")
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus")


def first_responder(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    first = first_success(turns, ["conv_id"], "turn", F.col("role") == "assistant", ["turn", "text"])
    return first.select("conv_id", "turn", F.md5("text").alias("digest"))


def landed_boards(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as board candidates of their country, in key order; balance and segment decide the response."""
    empty, wrong = F.col("c_acctbal") < 1000, F.col("c_mktsegment") == "BUILDING"
    lever = F.col("c_mktsegment") == "FURNITURE"
    body = (
        F.when(wrong, F.when(lever, F.lit("{}")).otherwise(F.lit("[]")))
        .when(lever, F.lit("[]"))
        .when(F.col("c_custkey") % 7 == 0, F.lit('{"jobs": null}'))
        .otherwise(F.lit('{"jobs": []}'))
    )
    return table(spark, sf, "customer").select(
        F.concat(F.lit("Co-"), F.col("c_nationkey").cast("string")).alias("company"),
        F.col("c_custkey").alias("rank"),
        F.when(lever, F.lit("lever")).otherwise(F.lit("ashby")).alias("platform"),
        F.col("c_name").alias("token"),
        F.when(~empty, body).alias("body"),
        F.when(F.col("c_acctbal") > 9000, F.lit("timeout")).alias("error"),
    )


def board_choice(spark: SparkSession, sf: str) -> DataFrame:
    """The first responding board per company; a response of the wrong shape or with an error is none."""
    rows = landed_boards(spark, sf)
    candidates = rows.select("company", "rank", "platform", "token")
    landed = rows.select("platform", "token", "body", "error")
    return first_boards(candidates, landed).select("company", "platform", "token")


def paper_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as papers; the source stands for the linked repository, so few repositories are shared by many."""
    note = F.concat(F.lit("Code: https://github.com/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit("."))
    return table(spark, sf, "documents").select(
        F.concat(F.lit("http://arxiv.org/abs/"), F.col("doc_id").cast("string"), F.lit("v1")).alias("entry_id"),
        F.col("doc_id"),
        F.concat(F.lit(" "), F.col("source"), F.lit(" ")).alias("title"),
        F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name"))).alias("authors"),
        F.when(F.col("lang") != "en", note).alias("comment"),
        F.when(F.col("lang") != "es", note).alias("summary"),
        (utc(AT) - F.make_dt_interval(mins=F.col("doc_id").cast("int"))).alias("published"),
    )


def repo_index(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.concat(F.lit('{"links":["https://github.com/q/r'), F.col("quality").cast("string"), F.lit('"]}'))
    return table(spark, sf, "labels").where("toxic = 0").select(F.col("doc_id").cast("string").alias("paper_id"), payload.alias("payload"))


def repo_stats(spark: SparkSession, sf: str) -> DataFrame:
    by_source = table(spark, sf, "documents").where("lang <> 'de'").groupBy(F.col("lang").alias("owner"), F.col("source").alias("repo")).agg(
        F.sum("n_chars").alias("stargazers_count")
    )
    by_label = table(spark, sf, "labels").groupBy(F.lit("q").alias("owner"), F.concat(F.lit("r"), F.col("quality").cast("string")).alias("repo")).agg(
        F.count(F.lit(1)).alias("stargazers_count")
    )
    return by_source.unionByName(by_label)


def left_lookup(spark: SparkSession, sf: str) -> DataFrame:
    linked = linked_repo(paper_rows(spark, sf), repo_index(spark, sf), "entry_id", "comment", "summary")
    return repo_stars(linked, repo_stats(spark, sf), "github_url", "doc_id").select("doc_id", "github_url", "github_stars")


def salted_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The star lookup alone with a low hot-key limit, so that every shared repository is salted."""
    papers = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("https://github.com/"), F.col("lang"), F.lit("/"), F.col("source")).alias("github_url")
    )
    return repo_stars(papers, repo_stats(spark, sf), "github_url", "doc_id", min_hot_rows=2).select("doc_id", "github_stars")


def company_rows(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.select(
        F.when(F.col("c_nationkey") != 7, F.col("c_name")).otherwise(F.lit("")).alias("name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.lower(F.replace("c_name", F.lit("#"), F.lit("-")))).alias("slug"),
        F.when(F.col("c_nationkey") > 3, F.concat(F.lit("https://x.example/"), F.col("c_custkey").cast("string"))).alias("url"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("bigint")).alias("team_size"),
        (F.col("c_nationkey") == 1).alias("top_company"),
        F.col("c_custkey").alias("seq"),
    )


def envelope_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = require(company_rows(spark, sf), "name")
    url = company_profile_url(F.col("slug"), F.col("url"))
    content = F.struct(F.col("name").alias("entityName"), F.struct("team_size").alias("data"))
    label = source_label(first_non_empty(F.col("slug"), F.col("name")), F.lit("greenhouse"))
    return rows.select("seq", *envelope("STARTUP", label, url, content, utc(AT))).select(
        "seq",
        "schemaVersion",
        "recordType",
        F.col("source.name").alias("source_name"),
        F.col("source.url").alias("source_url"),
        F.col("content.entityName").alias("entity_name"),
        F.col("content.data.employeeCount").alias("employees"),
        text_of(F.col("collectedAt")).alias("collected_at"),
    )


def startup_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The 1000 most prominent companies, with those whose country is 2 seen before."""
    companies = company_rows(spark, sf)
    seen = table(spark, sf, "customer").where("c_nationkey = 2").select(
        F.concat(F.lit(fv.COMPANY_PROFILE_BASE + "/"), F.lower(F.replace("c_name", F.lit("#"), F.lit("-")))).alias("url")
    )
    decisions = ingest.startups(companies, seen, 1000, utc(AT))
    return decisions.select(
        "url", "outcome", "copies", F.col("content.entityName").alias("entity_name"),
        F.col("content.data.employeeCount").alias("employees"),
    )


def post_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as paged product responses, fifty posts per page, built by Spark and parsed back from JSON."""
    part = table(spark, sf, "part")
    node = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.col("p_size") != 3, F.col("p_name")).alias("name"),
        F.col("p_type").alias("tagline"),
        F.when(F.col("p_size") > 40, F.lit("A Free plan")).when(F.col("p_size") > 30, F.lit("Enterprise, free trial")).alias("description"),
        F.concat(F.lit("https://p.example/"), F.col("p_name"), F.lit("/"), F.col("p_brand")).alias("url"),
        F.array(F.struct(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.lit("")).alias("name"))).alias("makers"),
    )
    page = F.floor(F.col("p_partkey") / 50).alias("page")
    pages = part.groupBy(page).agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", F.struct(node.alias("node")).alias("edge")))).alias("rows")
    )
    edges = F.struct(F.struct(F.col("rows.edge").alias("edges")).alias("posts")).alias("data")
    body = F.to_json(F.struct("page", edges))
    return pages.select(F.from_json(body, POST_PAGE).alias("body")).select("body.*")


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    posts = product_posts(post_pages(spark, sf))
    return posts.select(
        F.col("seq.page").alias("page"), F.col("seq.pos").alias("pos"), "id", "name", "tagline",
        F.get(F.col("makers.name"), F.lit(0)).alias("maker"),
    )


def cursor_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of fifty parts for seven feeds with cursors that say nothing of their order. In feed 1 the fourth page never landed; in
    feed 2 the second page is the last of the first two, and those from the third on lead round to the third."""
    feed, number = F.col("p_partkey") % 7, F.floor(F.col("p_partkey") / 350)
    pages = table(spark, sf, "part").groupBy(feed.alias("f"), number.alias("n")).agg(F.count(F.lit(1)).alias("posts"))
    last = pages.groupBy("f").agg(F.max("n").alias("last"))
    cursor = lambda n: F.md5(F.concat_ws("-", "f", n.cast("string")))
    following = F.when((F.col("f") == 2) & (F.col("n") == F.col("last")), F.lit(2)).otherwise(F.col("n") + 1)
    more = F.when(F.col("f") == 2, F.col("n") != 1).otherwise(F.col("n") < F.col("last"))
    return pages.join(last, "f").where("NOT (f = 1 AND n = 3)").select(
        F.concat(F.lit("feed"), F.col("f").cast("string")).alias("feed"), "n",
        F.when(F.col("n") > 0, cursor(F.col("n"))).alias("cursor"), cursor(following).alias("end_cursor"), more.alias("has_next"),
    )


def page_order(spark: SparkSession, sf: str) -> DataFrame:
    """The place of every page by its cursors, with breaks and circles."""
    pages = cursor_pages(spark, sf)
    places = page_places(pages).withColumn("cursor", F.nullif("cursor", F.lit("")))
    return pages.join(places, pages["feed"].eqNullSafe(places["feed"]) & pages["cursor"].eqNullSafe(places["cursor"])).select(
        pages["feed"], "n", "page", "status"
    )


def product_feed_order(spark: SparkSession, sf: str) -> DataFrame:
    """Product pages landed as files without page numbers, read back in feed order: the place of each post in the feed."""
    pages = post_pages(spark, sf)
    cursor = lambda n: F.md5(F.concat(F.lit("page "), n.cast("string")))
    last = pages.agg(F.max("page")).first()[0]
    info = F.struct((F.col("page") < last).alias("hasNextPage"), cursor(F.col("page") + 1).alias("endCursor"))
    posts = F.struct(F.col("data.posts.edges").alias("edges"), info.alias("pageInfo"))
    path = run_folder(spark, "product-pages")
    landed_pages = pages.select(F.when(F.col("page") > 0, cursor(F.col("page"))).alias("cursor"), F.struct(posts.alias("posts")).alias("data"))
    landed_pages.repartition(4, "cursor").write.json(path)
    back = read_product_pages(spark, path, by_cursor=True)
    return back.select("id", F.col("seq.page.page").alias("page"), F.col("seq.pos").alias("pos"))


def post_rows(spark: SparkSession, sf: str) -> DataFrame:
    posts = product_posts(post_pages(spark, sf))
    return posts.withColumn("url", F.replace("url", F.lit(" "), F.lit("-")))


def product_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The first 300 new products; URLs of one brand were seen before."""
    posts = post_rows(spark, sf)
    seen = posts.where(F.col("url").endswith("Brand#1")).select("url").distinct()
    kept = ingest.products(posts, seen, 300, utc(AT))
    return kept.select(
        "url", "copies", "raw_text", F.col("content.startupName").alias("startup"),
        F.col("content.pricingModel").alias("pricing"),
    )


def paper_ingest(spark: SparkSession, sf: str) -> DataFrame:
    entries = paper_rows(spark, sf).drop("doc_id")
    landing = run_folder(spark, "papers")
    entries.drop("doc_id").write.json(landing)
    entries = read_papers(spark, landing)
    seen = entries.where(F.col("title") == " src5 ").select(F.col("entry_id").alias("url"))
    decided = ingest.papers(entries, seen, repo_index(spark, sf), repo_stats(spark, sf), 500, utc(AT))
    content = F.col("content")
    return decided.where("outcome = 'saved'").select(
        "url", content["title"].alias("title"), F.array_join(content["authors"], ",").alias("authors"),
        content["github_url"].alias("github_url"), content["github_stars"].alias("stars"),
    )


def news_items(spark: SparkSession, sf: str) -> DataFrame:
    """Events as feed items: the kind decides relevance, some have no date."""
    kind = F.col("event_type")
    return keyed_events(spark, sf).select(
        F.concat(F.lit("https://n.example/"), F.col("user_id").cast("string"), F.lit("/"), F.get_json_object("props", "$.k")).alias("link"),
        F.col("event_id").alias("seq"),
        F.concat(F.lit("Feed "), kind).alias("source"),
        F.when(kind == "error", F.lit("Weather")).otherwise(F.lit("New AI model")).alias("title"),
        F.when(kind == "view", F.lit("about chatbots")).alias("summary"),
        F.when(kind == "click", F.lit("")).otherwise(F.date_format("ts", "dd MMM yyyy HH:mm:ss '+0000'")).alias("raw_date"),
    )


def news_ingest(spark: SparkSession, sf: str) -> DataFrame:
    items = news_items(spark, sf)
    seen = items.where("source = 'Feed signup'").select(F.col("link").alias("url"))
    pages = items.where("source = 'Feed purchase'").select(
        F.col("link").alias("url"), F.concat(F.lit("<html><nav>x</nav><p>Body of "), F.col("link"), F.lit("</p></html>")).alias("html")
    )
    decided = ingest.news(items, seen, pages, utc("2024-01-31T00:00:00Z"), utc(AT), ["seq"])
    return decided.select(
        "url", "outcome", "copies", F.col("source.name").alias("feed"),
        text_of(F.col("content.publishedDate")).alias("published"), F.col("content.fullText").alias("full_text"),
    )


def board_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """One board response per row: orders, events and customers in the three dialects."""
    def body(platform: str, name: str, df: DataFrame, job, listed: bool) -> DataFrame:
        jobs = F.array(job)
        text = F.to_json(jobs if listed else F.struct(jobs.alias("jobs")))
        return df.select(F.concat(F.lit("Co-"), F.col(name).cast("string")).alias("company"), F.lit(platform).alias("platform"), text.alias("body"))

    orders, rows, customer = table(spark, sf, "orders"), events(spark, sf), table(spark, sf, "customer")
    greenhouse = F.struct(
        F.concat(F.lit("https://g.example/"), F.col("o_orderkey").cast("string")).alias("absolute_url"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.concat(F.lit("Engineer "), F.col("o_orderstatus")).alias("title"),
        F.struct(F.when(F.col("o_orderstatus") == "F", F.lit("Remote")).otherwise(F.lit("Paris")).alias("name")).alias("location"),
    )
    lever = F.struct(
        F.concat(F.lit("https://l.example/"), F.col("event_id").cast("string")).alias("hostedUrl"),
        F.unix_millis("ts").alias("createdAt"),
        F.when(F.col("event_type") == "view", F.lit("HR lead")).otherwise(F.lit("Counsel")).alias("text"),
        F.when(F.col("event_type") != "error", F.struct(F.lit("remote, EU").alias("location"))).alias("categories"),
    )
    ashby = F.struct(
        F.when(F.col("c_nationkey") > 4, F.concat(F.lit("https://a.example/"), F.col("c_custkey").cast("string"))).alias("jobUrl"),
        F.concat(F.lit("https://a.example/apply/"), F.col("c_custkey").cast("string")).alias("applyUrl"),
        F.lit("2 hours ago").alias("publishedAt"),
        F.col("c_mktsegment").alias("title"),
        F.lit("Remote").alias("location"),
        F.when(F.col("c_nationkey") == 9, F.lit(False)).alias("isRemote"),
    )
    merged = body("greenhouse", "o_custkey", orders, greenhouse, False)
    merged = merged.unionByName(body("lever", "user_id", rows, lever, True))
    return merged.unionByName(body("ashby", "c_custkey", customer, ashby, False))


BOARD_NOW = "2024-01-20T00:00:00Z"


def union_dialects(spark: SparkSession, sf: str) -> DataFrame:
    jobs = board_jobs(board_bodies(spark, sf), utc(BOARD_NOW))
    return jobs.select(
        "company", "platform", "job_url", "title", "location", "remote", text_of(F.col("published")).alias("published")
    )


def job_ingest(spark: SparkSession, sf: str) -> DataFrame:
    jobs = board_jobs(board_bodies(spark, sf), utc(BOARD_NOW))
    seen = jobs.where("title = 'HR lead'").select(F.col("job_url").alias("url"))
    decided = ingest.jobs(jobs, seen, utc(BOARD_NOW), utc(AT))
    content = F.col("content")
    return decided.select(
        "url", "outcome", F.col("source.name").alias("label"), content["role_family"].alias("role_family"),
        content["is_remote"].alias("is_remote"), is_fresh(content["date"], utc(BOARD_NOW)).alias("fresh"),
    )


_KEYED = "SELECT *, user_id || ':' || event_type || ':' || props AS url FROM events"
_SEEN = f"SELECT url FROM ({_KEYED}) WHERE ts < TIMESTAMP '2024-01-16'"
_NEW = f"SELECT * FROM ({_KEYED}) WHERE ts >= TIMESTAMP '2024-01-16'"
_COMPANIES = """SELECT CASE WHEN c_nationkey <> 7 THEN c_name ELSE '' END AS name,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(replace(c_name, '#', '-')) END AS slug,
    CASE WHEN c_nationkey > 3 THEN 'https://x.example/' || c_custkey END AS url,
    CASE WHEN c_acctbal > 0 THEN CAST(trunc(c_acctbal) AS BIGINT) END AS team_size,
    c_nationkey = 1 AS top_company, c_custkey AS seq FROM customer"""
_PROFILE = """coalesce('https://www.ycombinator.com/companies/' || slug, url, 'https://www.ycombinator.com/companies')"""
_FIRST_NEW = f"""SELECT url, min(event_id) AS event_id FROM ({_NEW}) WHERE url NOT IN ({_SEEN}) GROUP BY url"""
_PAPERS = """SELECT doc_id, 'http://arxiv.org/abs/' || doc_id || 'v1' AS url, source, lang,
    CASE WHEN l.toxic = 0 THEN 'https://github.com/q/r' || l.quality
      ELSE 'https://github.com/' || lang || '/' || source END AS github_url
  FROM documents LEFT JOIN labels l USING (doc_id)"""
_STATS = """SELECT 'https://github.com/' || lang || '/' || source AS github_url, sum(n_chars)::BIGINT AS stars
    FROM documents WHERE lang <> 'de' GROUP BY ALL
  UNION ALL SELECT 'https://github.com/q/r' || quality, count(*) FROM labels GROUP BY quality"""
_POSTS = """SELECT p_partkey AS seq, p_partkey // 50 AS page, p_partkey % 50 AS pos, p_partkey::VARCHAR AS id,
    CASE WHEN p_size <> 3 THEN p_name END AS name, p_type AS tagline,
    CASE WHEN p_size > 40 THEN 'A Free plan' WHEN p_size > 30 THEN 'Enterprise, free trial' END AS description,
    replace('https://p.example/' || p_name || '/' || p_brand, ' ', '-') AS url,
    CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS maker FROM part"""
_ITEMS = """SELECT 'https://n.example/' || user_id || '/' || json_extract_string(props, '$.k') AS url, event_id AS seq,
    'Feed ' || event_type AS feed, event_type, CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS published
  FROM events"""
_JOBS = """SELECT 'Co-' || o_custkey AS company, 'greenhouse' AS platform, 'https://g.example/' || o_orderkey AS job_url,
      'Engineer ' || o_orderstatus AS title, CASE WHEN o_orderstatus = 'F' THEN 'Remote' ELSE 'Paris' END AS location,
      CAST(NULL AS BOOLEAN) AS remote, CAST(o_orderdate AS TIMESTAMP) AS published, 'Engineering' AS family
    FROM orders
  UNION ALL SELECT 'Co-' || user_id, 'lever', 'https://l.example/' || event_id,
      CASE WHEN event_type = 'view' THEN 'HR lead' ELSE 'Counsel' END,
      CASE WHEN event_type <> 'error' THEN 'remote, EU' END, NULL, date_trunc('millisecond', ts),
      CASE WHEN event_type = 'view' THEN 'People' ELSE 'Legal' END FROM events
  UNION ALL SELECT 'Co-' || c_custkey, 'ashby',
      CASE WHEN c_nationkey > 4 THEN 'https://a.example/' ELSE 'https://a.example/apply/' END || c_custkey,
      c_mktsegment, 'Remote', CASE WHEN c_nationkey = 9 THEN false END, TIMESTAMP '2024-01-19 22:00:00', NULL FROM customer"""

QUERIES = {
    "seen_anti_join": seen_anti_join,
    "seen_small_batch": seen_small_batch,
    "seen_key_rows": seen_key_rows,
    "ingest_accounting": ingest_accounting,
    "validate_split": validate_split,
    "prominence_topk": prominence,
    "limit_new_rows": limit_new_rows,
    "newest_first": newest,
    "latest_per_key": latest_orders,
    "first_responder": first_responder,
    "board_choice": board_choice,
    "left_lookup": left_lookup,
    "salted_lookup": salted_lookup,
    "envelope_rows": envelope_rows,
    "startup_ingest": startup_ingest,
    "product_pages": product_pages,
    "page_order": page_order,
    "product_feed_order": product_feed_order,
    "product_ingest": product_ingest,
    "paper_ingest": paper_ingest,
    "news_ingest": news_ingest,
    "union_dialects": union_dialects,
    "job_ingest": job_ingest,
}

ORACLE = {
    "seen_anti_join": _FIRST_NEW,
    "seen_small_batch": _FIRST_NEW,
    "seen_key_rows": f"""SELECT url, 'NEWS' AS record_type, '2024-02-01 00:00:00.000000' AS first_seen_at
      FROM ({_FIRST_NEW})""",
    "ingest_accounting": f"""SELECT outcome, count(*) AS keys, sum(copies)::BIGINT AS input_rows,
        (sum(copies) - count(*))::BIGINT AS duplicates
      FROM (SELECT url, copies, CASE WHEN url IN ({_SEEN}) THEN 'already_seen' WHEN event_type = 'error' THEN 'dateless'
          WHEN ts < (SELECT max(ts) FROM events) - INTERVAL 24 HOUR THEN 'stale' ELSE 'saved' END AS outcome
        FROM (SELECT url, event_type, ts, count(*) OVER (PARTITION BY url) AS copies,
            row_number() OVER (PARTITION BY url ORDER BY event_id) AS r FROM ({_NEW})) WHERE r = 1)
      GROUP BY outcome""",
    "validate_split": """SELECT doc_id, concat_ws('; ', CASE WHEN quality IS NULL THEN 'quality is missing' END,
        CASE WHEN lang NOT IN ('en', 'fr', 'de') THEN 'lang is not allowed' END,
        CASE WHEN NOT regexp_matches(coalesce(source, ''), '^src[0-9]$') THEN 'source is not a source' END) AS reasons
      FROM documents LEFT JOIN labels USING (doc_id)""",
    "prominence_topk": """SELECT c_custkey, c_name FROM customer
      ORDER BY c_mktsegment = 'BUILDING' DESC, c_acctbal DESC, c_custkey LIMIT 100""",
    "limit_new_rows": """SELECT o_orderkey, o_custkey FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ORDER BY o_orderkey LIMIT 1000""",
    "newest_first": f"""SELECT o_orderkey, {sql_text('o_orderdate')} AS o_orderdate FROM orders
      ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 500""",
    "latest_per_key": """SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""",
    "first_responder": """SELECT conv_id, min(turn) AS turn, md5(arg_min(text, turn)) AS digest
      FROM conversations WHERE role = 'assistant' GROUP BY conv_id""",
    "board_choice": """SELECT 'Co-' || c_nationkey AS company,
        arg_min(CASE WHEN c_mktsegment = 'FURNITURE' THEN 'lever' ELSE 'ashby' END, c_custkey) AS platform,
        arg_min(c_name, c_custkey) AS token
      FROM customer WHERE c_acctbal BETWEEN 1000 AND 9000 AND c_mktsegment <> 'BUILDING'
        AND (c_mktsegment = 'FURNITURE' OR c_custkey % 7 <> 0) GROUP BY c_nationkey""",
    "left_lookup": f"""SELECT doc_id, github_url, stars AS github_stars FROM ({_PAPERS}) LEFT JOIN ({_STATS}) USING (github_url)""",
    "salted_lookup": """SELECT d.doc_id, s.n AS github_stars FROM documents d LEFT JOIN
      (SELECT lang, source, sum(n_chars)::BIGINT AS n FROM documents WHERE lang <> 'de' GROUP BY ALL) s USING (lang, source)""",
    "envelope_rows": f"""SELECT seq, '1.0' AS "schemaVersion", 'STARTUP' AS "recordType",
        coalesce(slug, name) || ' (Greenhouse)' AS source_name, {_PROFILE} AS source_url, name AS entity_name,
        team_size AS employees, '2024-02-01 00:00:00.000000' AS collected_at
      FROM ({_COMPANIES}) WHERE name <> ''""",
    "startup_ingest": f"""SELECT url, CASE WHEN url IN (SELECT 'https://www.ycombinator.com/companies/'
          || lower(replace(c_name, '#', '-')) FROM customer WHERE c_nationkey = 2) THEN 'already_seen' ELSE 'saved' END AS outcome,
        count(*) AS copies, arg_min(name, seq) AS entity_name, list(team_size ORDER BY seq)[1] AS employees
      FROM (SELECT {_PROFILE} AS url, name, team_size, seq FROM (SELECT * FROM ({_COMPANIES})
          ORDER BY top_company DESC, coalesce(team_size, 0) DESC, seq LIMIT 1000) WHERE name <> '') GROUP BY url""",
    "page_order": """SELECT 'feed' || f AS feed, n,
        CASE WHEN f = 1 AND n > 3 THEN n - 4 WHEN f = 2 AND n > 1 THEN NULL ELSE n END AS page,
        CASE WHEN f = 1 AND n > 3 THEN 'break' WHEN f = 2 AND n > 1 THEN 'cycle' ELSE 'ordered' END AS status
      FROM (SELECT DISTINCT p_partkey % 7 AS f, p_partkey // 350 AS n FROM part) WHERE NOT (f = 1 AND n = 3)""",
    "product_feed_order": f"""SELECT id, page, CAST(pos AS INTEGER) AS pos FROM ({_POSTS})""",
    "product_pages": f"""SELECT page, CAST(pos AS INTEGER) AS pos, id, name, tagline, maker FROM ({_POSTS})""",
    "product_ingest": f"""SELECT url, copies, raw_text, startup, pricing FROM (SELECT url, min(seq) AS seq, count(*) AS copies,
          list(concat_ws(' ', tagline, description) ORDER BY seq)[1] AS raw_text,
          list(CASE WHEN maker <> '' THEN maker ELSE name END ORDER BY seq)[1] AS startup,
          list(CASE WHEN description LIKE 'Enterprise%' THEN 'ENTERPRISE' WHEN description LIKE 'A Free%' THEN 'FREE' END
            ORDER BY seq)[1] AS pricing
        FROM ({_POSTS}) WHERE name IS NOT NULL AND NOT ends_with(url, 'Brand#1') GROUP BY url)
      ORDER BY seq LIMIT 300""",
    "paper_ingest": f"""SELECT url, source AS title, lang || ',' || source AS authors, github_url, stars
      FROM (SELECT * FROM ({_PAPERS}) ORDER BY doc_id LIMIT 500) LEFT JOIN ({_STATS}) USING (github_url)
      WHERE source <> 'src5'""",
    "news_ingest": f"""SELECT url, outcome, copies, feed, {sql_text('published')} AS published,
        CASE WHEN outcome = 'saved' AND url IN (SELECT url FROM ({_ITEMS}) WHERE event_type = 'purchase')
          THEN 'Body of ' || url END AS full_text
      FROM (SELECT *, CASE WHEN url IN (SELECT url FROM ({_ITEMS}) WHERE event_type = 'signup') THEN 'already_seen'
          WHEN event_type = 'error' THEN 'irrelevant'
          WHEN published < TIMESTAMP '2024-01-30' THEN 'stale' ELSE 'saved' END AS outcome
        FROM (SELECT *, count(*) OVER (PARTITION BY url) AS copies,
          row_number() OVER (PARTITION BY url ORDER BY seq) AS r FROM ({_ITEMS})) WHERE r = 1)""",
    "union_dialects": f"""SELECT company, platform, job_url, title, location, remote, {sql_text('published')} AS published
      FROM ({_JOBS})""",
    "job_ingest": f"""SELECT job_url AS url, CASE WHEN title = 'HR lead' THEN 'already_seen'
          WHEN published < TIMESTAMP '2024-01-19' THEN 'stale' ELSE 'saved' END AS outcome,
        company || ' (' || upper(left(platform, 1)) || substr(platform, 2) || ')' AS label, family AS role_family,
        coalesce(remote, location <> 'Paris') AS is_remote, published >= TIMESTAMP '2024-01-19' AS fresh
      FROM ({_JOBS})""",
}
