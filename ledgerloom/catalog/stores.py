"""Queries that write with the store, the exports or a landing, and read back.

Each run writes to a folder of its own below the cluster's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.catalog.ingests import company_rows
from ledgerloom.catalog.reports import (
    job_records,
    mapping_records,
    news_records,
    paper_records,
    product_records,
    startup_records,
)
from ledgerloom.catalog.tables import table, utc
from ledgerloom.plans import refine
from ledgerloom.operators.dedup import exclude_seen, first_per_key
from ledgerloom.operators.ranking import numbered
from ledgerloom.session import run_folder, written
from ledgerloom.sinks.exports import export_json, export_tabs
from ledgerloom.sinks.store import Store, apply_updates, matched_updates
from ledgerloom.sources.landed import feed_items, read_atom, read_companies, read_rss, rejected_entries, rejected_file_entries, union_feeds
from ledgerloom.sources.seeds import seed_names

AT = "2024-02-01T00:00:00Z"


def new_store(spark: SparkSession, label: str) -> Store:
    return Store(spark, run_folder(spark, label))


def store_commits(spark: SparkSession, sf: str) -> DataFrame:
    """Three commits: one language, everything, and a replay of the second. No record is stored twice."""
    store = new_store(spark, "commits")
    news = news_records(spark, sf).withColumn("url", F.col("source.url"))
    for batch_id, batch in ((1, news.where("source.name = 'en'")), (2, news), (2, news)):
        fresh = exclude_seen(first_per_key(batch, ["url"], "collectedAt"), store.seen(batch_id), "url")
        rejected = fresh.where("content.title = 'src1'").select("url")
        store.commit("NEWS", batch_id, fresh.where("content.title <> 'src1'").drop("url"), rejected, utc(AT))
    records = store.record_types().groupBy("record_type", "batch_id").agg(F.count(F.lit(1)).alias("records"))
    seen = store.seen().groupBy("record_type", "batch_id").agg(F.count(F.lit(1)).alias("seen"))
    return records.join(seen, ["record_type", "batch_id"], "full")


def store_two_types(spark: SparkSession, sf: str) -> DataFrame:
    """Two types committed under one batch id, the same rows again under the next: nothing is stored twice."""
    store = new_store(spark, "two-types")
    batches = {"STARTUP": startup_records(spark, sf), "PRODUCT": product_records(spark, sf)}
    none = table(spark, sf, "region").select(F.col("r_name").alias("url")).where(F.lit(False))
    for batch_id in (17, 18):
        for kind, records in batches.items():
            keyed = first_per_key(records.withColumn("url", F.col("source.url")), ["url"], "content")
            fresh = exclude_seen(keyed, store.seen(batch_id, kind, keyed), "url")
            store.commit(kind, batch_id, fresh.drop("url"), none, utc(AT))
        if batch_id == 17:
            store.compact_seen("STARTUP", 17)
    rows = store.record_types().groupBy("record_type", "batch_id").agg(F.count(F.lit(1)).alias("records"))
    seen = store.seen().groupBy("record_type").agg(F.count(F.lit(1)).alias("seen"), F.count_distinct("url").alias("urls"))
    return rows.join(seen, "record_type", "full")


def seen_few_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' keys marked in two batches and compacted; a batch of a few hundred old and new keys looks its own up, by pushed filters."""
    store = new_store(spark, "few-keys")
    orders = table(spark, sf, "orders").select(F.concat(F.lit("https://o.example/"), F.col("o_orderkey").cast("string")).alias("url"), "o_orderkey", "o_orderstatus")
    none = news_records(spark, sf).where(F.lit(False))
    store.commit("NEWS", 1, none, orders.where("o_orderstatus = 'F'"), utc(AT))
    store.commit("JOB", 2, job_records(spark, sf).where(F.lit(False)), orders.where("o_orderstatus = 'O'"), utc(AT))
    store.compact_seen("NEWS", 1)
    batch = table(spark, sf, "supplier").select(F.concat(F.lit("https://o.example/"), (F.col("s_suppkey") * 7).cast("string")).alias("url"))
    return exclude_seen(batch, store.seen(3, "JOB", batch), "url").select("url")


def raw_text_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Texts by order key stored in two batches; the later batch and the later row win."""
    store = new_store(spark, "texts")
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("HTTPS://O.example/"), F.col("o_custkey").cast("string")).alias("url"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("-"), "o_orderstatus").alias("raw_text"),
        F.col("o_orderkey").alias("seq"),
        "o_orderstatus",
    )
    store.append_raw_text(orders.where("o_orderstatus <> 'F'"), 1)
    store.append_raw_text(orders.where("o_orderstatus = 'F'"), 2)
    return store.raw_text().select("url", "raw_text")


def record_update(spark: SparkSession, sf: str) -> DataFrame:
    """Products with one brand's pricing replaced, and how many updates found their record."""
    records = product_records(spark, sf)
    updates = table(spark, sf, "part").where("p_brand = 'Brand#3'").select(
        F.concat(F.lit("HTTPS://p.example/"), F.col("p_partkey").cast("string")).alias("url"),
        F.struct(F.col("p_name").alias("startupName"), F.lit("ENTERPRISE").alias("pricingModel")).alias("content"),
    )
    updated = apply_updates(records, updates)
    counts = updated.groupBy(F.col("content.pricingModel").alias("pricing")).agg(F.count(F.lit(1)).alias("n"))
    matched = matched_updates(records, updates).select(F.lit("matched updates").alias("pricing"), F.col("matched").alias("n"))
    return counts.unionByName(matched)


def filled_store(spark: SparkSession, sf: str, label: str) -> Store:
    store = new_store(spark, label)
    makers = {
        "STARTUP": startup_records, "PRODUCT": product_records, "RESEARCH_PAPER": paper_records,
        "JOB": job_records, "NEWS": news_records,
    }
    for kind, records in makers.items():
        store.append_records(records(spark, sf), kind, 1)
    store.append_mappings(mapping_records(spark, sf).withColumn("url", F.col("raw_name")), 1)
    return store


JSON_FIELDS = {
    "startups": ("$.source.url", "$.content.entityName", "$.content.data.employeeCount"),
    "products": ("$.source.url", "$.content.startupName", "$.content.pricingModel"),
    "papers": ("$.source.url", "$.content.title", "$.content.github_stars"),
    "jobs": ("$.source.url", "$.content.company", "$.content.is_remote"),
    "news": ("$.source.url", "$.content.title", "$.content.publishedDate"),
    "entity_mappings": ("$.raw", "$.canonical", "$.confidence"),
    "summary": ("$.startups", "$.products", "$.productsWithPricing"),
}
TAB_FIELDS = {
    "Startups": ("source.url", "entityName", "employeeCount"),
    "Products": ("source.url", "startupName", "pricingModel"),
    "Research Papers": ("source.url", "authors", "github_stars"),
    "Jobs": ("source.url", "company", "is_remote"),
    "News": ("source.url", "title", "publishedDate"),
    "Entity Mapping Log": fv.MAPPING_HEADER,
}


def _merged(parts: list[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def json_export(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of all JSON exports read back: the set's name and three of its fields as text."""
    store = filled_store(spark, sf, "json")
    root = f"{store.root}/export"
    export_json(store, root)
    parts = []
    for name, paths in JSON_FIELDS.items():
        first, second, third = (F.get_json_object("value", p) for p in paths)
        parts.append(spark.read.text(f"{root}/{name}").select(F.lit(name).alias("name"), first.alias("a"), second.alias("b"), third.alias("c")))
    return _merged(parts)


def mapping_export(spark: SparkSession, sf: str) -> DataFrame:
    """The exported mappings by their place in the files, confidences falling and names in order of their URL."""
    store = filled_store(spark, sf, "mapping-order")
    root = f"{store.root}/export"
    export_json(store, root)
    lines = spark.read.text(f"{root}/entity_mappings").withColumn("part", F.col("_metadata.file_path"))
    placed = numbered(lines.withColumn("line", F.monotonically_increasing_id()), [F.col("part"), F.col("line")], "place")
    return placed.select("place", F.get_json_object("value", "$.raw").alias("raw"))


def tab_export(spark: SparkSession, sf: str) -> DataFrame:
    """All six flat tables, written with their headers and read back: the tab and three of its cells."""
    store = filled_store(spark, sf, "tabs")
    root = f"{store.root}/export"
    export_tabs(store, root)
    parts = []
    for tab, names in TAB_FIELDS.items():
        back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{root}/{tab}")
        cells = [F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names]
        parts.append(back.select(F.lit(tab).alias("tab"), *[c.alias(n) for c, n in zip(cells, "abc")]))
    return _merged(parts)


def resolved_store(spark: SparkSession, sf: str) -> DataFrame:
    """Names of stored startups and products against the shipped seed: an exact name, an alias, a typo, an unknown one."""
    store = new_store(spark, "resolve")
    kind = F.col("content.data.employeeCount") % 4
    spelled = F.when(kind == 0, F.lit("OpenAI, Inc.")).when(kind == 1, F.lit("Open AI")).when(kind == 2, F.lit("Antropic"))
    startups = startup_records(spark, sf).withColumn(
        "content", F.col("content").withField("entityName", F.coalesce(spelled, F.lit("Qwzx Unheard Of")))
    )
    store.append_records(startups, "STARTUP", 1)
    store.append_records(product_records(spark, sf), "PRODUCT", 1)
    counts = refine.resolve_names(store, seed_names(spark), 1)
    logged = store.mappings(1).groupBy(F.col("canonical_name").alias("method")).agg(F.count(F.lit(1)).alias("records"))
    known = logged.where(F.col("method").isin("OpenAI", "Anthropic", "Qwzx Unheard Of"))
    return counts.unionByName(known)


def backfilled_store(spark: SparkSession, sf: str) -> DataFrame:
    """Pricing filled in the store itself from answers that are valid, not allowed, or errors."""
    store = new_store(spark, "backfill")
    products = product_records(spark, sf)
    store.append_records(products, "PRODUCT", 1)
    key = F.regexp_extract("source.url", r"(\d+)$", 1).cast("bigint")
    urls = products.select(F.col("source.url").alias("url"), key.alias("n"))
    store.append_raw_text(urls.where("n % 5 <> 0").select("url", F.lit("text").alias("raw_text"), F.lit(0).alias("seq")), 1)
    answer = F.when(F.col("n") % 3 == 0, F.lit("free")).otherwise(F.lit("cheap"))
    body = F.concat(F.lit('{"choices":[{"message":{"content":"{\\"pricingModel\\": \\"'), answer, F.lit('\\"}"}}]}'))
    failed = F.col("n") % 7 == 0
    responses = urls.select(
        F.col("url").alias("key"), F.lit("groq").alias("provider"), F.when(~failed, body).alias("body"),
        F.when(failed, F.lit("timeout")).alias("error"), F.lit(1).cast("bigint").alias("seq"),
    )
    report = refine.backfill_pricing(store, responses, 2)
    rows = store.current("PRODUCT").groupBy(F.col("content.pricingModel").alias("pricing")).agg(F.count(F.lit(1)).alias("n"))
    attempted = report.select(F.lit("attempted").alias("pricing"), F.col("attempted").alias("n"))
    return rows.unionByName(attempted).unionByName(report.select(F.lit("backfilled").alias("pricing"), F.col("backfilled").alias("n")))


def enriched_store(spark: SparkSession, sf: str) -> DataFrame:
    """Stored news enriched from answers; texts without an answer are logged too."""
    store = new_store(spark, "enrich")
    news = news_records(spark, sf)
    store.append_records(news, "NEWS", 1)
    body = F.lit('{"choices":[{"message":{"content":"{\\"topic\\": \\"ai\\"}"}}]}')
    responses = news.where("source.name <> 'de'").select(
        F.col("source.url").alias("key"), F.lit("groq").alias("provider"), F.when(F.col("source.name") == "en", body).alias("body"),
        F.when(F.col("source.name") != "en", F.lit("timeout")).alias("error"), F.lit(1).cast("bigint").alias("seq"),
    )
    counted = refine.enrich_news(store, responses, 2, utc(AT))
    used = store.enriched().groupBy(F.coalesce("providerUsed", F.lit("none")).alias("provider")).agg(F.count(F.lit(1)).alias("n"))
    return used.unionByName(counted.select(F.lit("succeeded").alias("provider"), F.col("succeeded").alias("n")))


def company_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Companies landed as JSON lines, read with the snapshot schema."""
    path = run_folder(spark, "companies")
    company_rows(spark, sf).drop("seq").write.json(path)
    return read_companies(spark, path, multiline=False).drop("seq")


def feed_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """One landed feed body per event: Atom for clicks, RSS for the rest, and none for sign-ups.

    Atom entries have an enclosure before their own link and, each second one, content instead of a summary. RSS
    items of views are dated by ``dc:date``; every fifth purchase has a bare ampersand, every seventh view is cut off.
    """
    kind = F.col("event_type")
    title = F.concat(kind, F.lit(" &amp; more"))
    link = F.concat(F.lit("https://f.example/"), F.col("event_id").cast("string"))
    props = F.replace(F.col("props"), F.lit('"'), F.lit("&quot;"))
    date = F.when(kind != "error", F.date_format("ts", "d MMM yyyy HH:mm:ss 'GMT'"))
    rss = F.concat(
        F.lit("<rss><channel><title>feed</title><item><title>"), title,
        F.when((kind == "purchase") & (F.col("event_id") % 5 == 0), F.lit(" & so on")).otherwise(F.lit("")),
        F.lit("</title><link> "), link, F.lit(" </link><description>"), props, F.lit("</description>"),
        F.when(kind == "view", F.concat(F.lit("<dc:date>"), date, F.lit("</dc:date>")))
        .otherwise(F.coalesce(F.concat(F.lit("<pubDate>"), date, F.lit("</pubDate>")), F.lit(""))),
        F.when((kind == "view") & (F.col("event_id") % 7 == 0), F.lit("</item><item><title>cut"))
        .otherwise(F.lit("</item></channel></rss>")),
    )
    atom = F.concat(
        F.lit('<feed><title>feed</title><entry><title type="text">'), title, F.lit('</title><link rel="enclosure" href="https://f.example/x.mp3"/>'),
        F.lit('<link rel="alternate" href="'), link, F.lit('"/>'),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("<summary>"), props, F.lit("</summary>")))
        .otherwise(F.concat(F.lit('<content type="html">'), props, F.lit("</content>"))),
        F.lit("<updated>"), date, F.lit("</updated></entry></feed>"),
    )
    body = F.when(kind == "click", atom).when(kind != "signup", rss)
    return table(spark, sf, "events").select(kind.alias("source"), body.alias("body"))


def feed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return feed_items(feed_bodies(spark, sf)).drop("seq")


def feed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies and entries that cannot be read, by source and reason."""
    lost = rejected_entries(feed_bodies(spark, sf))
    return lost.groupBy("source", "reject_reason").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_place"))


def feed_files(spark: SparkSession, sf: str, label: str) -> dict[str, tuple[str, str]]:
    """All feed bodies landed as files of some thousand entries: source -> kind of feed and folder, one of which never arrived.

    Entries keep their bare ampersands, and the files of views end in the middle of an entry.
    """
    whole = feed_bodies(spark, sf).where(F.col("body").isNotNull())
    entries = whole.select("source", F.regexp_extract("body", r"(?s)<(item|entry)>.*?</\1>", 0).alias("entry"))
    number = F.regexp_extract("entry", r"f\.example/(\d+)", 1).cast("bigint")
    files = entries.groupBy("source", F.floor(number / 2500).alias("file")).agg(F.array_join(F.collect_list("entry"), "").alias("all"))
    atom = F.concat(F.lit("<feed>"), F.col("all"), F.lit("</feed>"))
    rest = F.when(F.col("source") == "view", F.lit("<item><title>cut")).otherwise(F.lit("</channel></rss>"))
    rss = F.concat(F.lit('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'), F.col("all"), rest)
    bodies = files.select("source", "file", F.when(F.col("source") == "click", atom).otherwise(rss).alias("body"))
    bodies = written(bodies, "feed-files")
    root, landed = run_folder(spark, label), {}
    for number, (name, kind) in enumerate(zip(fv.FEEDS, ("click", "view", "purchase", "error", None))):
        if kind:
            bodies.where(F.col("source") == kind).select("body", "file").write.partitionBy("file").text(f"{root}/{number}")
        landed[name] = ("atom" if kind == "click" else "rss", f"{root}/{number}")
    return landed


def feed_union(spark: SparkSession, sf: str) -> DataFrame:
    """Every complete entry of the landed feeds: one Atom, the others RSS, and one that never arrived."""
    readers = {"atom": read_atom, "rss": read_rss}
    landed = feed_files(spark, sf, "feeds")
    return union_feeds({name: lambda source, kind=kind, folder=folder: readers[kind](spark, folder, source) for name, (kind, folder) in landed.items()})


def feed_file_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What the landed feed files lose: files with a cut-off or broken entry, by source and reason."""
    lost = None
    for name, (kind, folder) in list(feed_files(spark, sf, "feed-rejects").items())[:-1]:
        own = rejected_file_entries(spark, folder, name, kind)
        lost = own if lost is None else lost.unionByName(own)
    return lost.groupBy("source", "reject_reason").agg(F.count_distinct("file").alias("files"), F.sum("n").alias("entries"))


_NEWS = "SELECT doc_id, lang, source FROM documents"
_PRICING = "CASE WHEN p_size > 40 THEN 'FREE' WHEN p_size > 20 THEN 'PAID' WHEN p_size > 10 THEN '' END"

_FEEDS = """SELECT event_id, event_type, props, 'https://f.example/' || event_id AS link,
    event_type || ' & more' || CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN ' & so on' ELSE '' END AS title,
    CASE WHEN event_type <> 'error' THEN strftime(ts, '%-d %b %Y %H:%M:%S GMT') END AS raw_date
  FROM events WHERE event_type <> 'signup'"""

QUERIES = {
    "store_commits": store_commits,
    "store_two_types": store_two_types,
    "seen_few_keys": seen_few_keys,
    "raw_text_latest": raw_text_latest,
    "record_update": record_update,
    "json_export": json_export,
    "tab_export": tab_export,
    "mapping_export": mapping_export,
    "resolved_store": resolved_store,
    "backfilled_store": backfilled_store,
    "enriched_store": enriched_store,
    "company_snapshot": company_snapshot,
    "feed_items": feed_rows,
    "feed_rejects": feed_rejects,
    "feed_union": feed_union,
    "feed_file_rejects": feed_file_rejects,
}

ORACLE = {
    "store_commits": f"""SELECT 'NEWS' AS record_type, CASE WHEN lang = 'en' THEN 1 ELSE 2 END::BIGINT AS batch_id,
        count(*) FILTER (source <> 'src1') AS records, count(*) AS seen FROM ({_NEWS}) GROUP BY ALL""",
    "store_two_types": """SELECT record_type, 17::BIGINT AS batch_id, count(DISTINCT url) AS records, count(DISTINCT url) AS seen,
        count(DISTINCT url) AS urls
      FROM (SELECT 'PRODUCT' AS record_type, 'https://p.example/' || p_partkey AS url FROM part
        UNION ALL SELECT 'STARTUP', 'https://c.example/' || c_custkey FROM customer) GROUP BY record_type""",
    "seen_few_keys": """SELECT 'https://o.example/' || 7 * s_suppkey AS url FROM supplier
      WHERE 7 * s_suppkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O'))""",
    "raw_text_latest": """SELECT 'https://o.example/' || o_custkey AS url,
        arg_max(o_orderkey || '-' || o_orderstatus, (o_orderstatus = 'F', o_orderkey)) AS raw_text FROM orders GROUP BY o_custkey""",
    "record_update": f"""SELECT CASE WHEN p_brand = 'Brand#3' THEN 'ENTERPRISE' ELSE {_PRICING} END AS pricing, count(*) AS n
      FROM part GROUP BY ALL UNION ALL SELECT 'matched updates', count(*) FROM part WHERE p_brand = 'Brand#3'""",
    "json_export": f"""SELECT 'startups' AS name, 'https://c.example/' || c_custkey AS a, c_name AS b, c_nationkey::VARCHAR AS c FROM customer
      UNION ALL SELECT 'products', 'https://p.example/' || p_partkey, p_name, {_PRICING} FROM part
      UNION ALL SELECT 'papers', 'https://d.example/' || doc_id, source, quality::VARCHAR FROM documents LEFT JOIN labels USING (doc_id)
      UNION ALL SELECT 'jobs', 'https://j.example/' || o_orderkey, 'Co ' || o_custkey,
        CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END FROM orders
      UNION ALL SELECT 'news', 'https://n.example/' || doc_id, source, CASE WHEN lang = 'de' THEN '2024-02-01T00:00:00.000Z' END FROM documents
      UNION ALL SELECT 'entity_mappings', s_name, upper(s_name),
        CASE WHEN s_nationkey > 12 THEN (s_nationkey / 32.0)::DOUBLE::VARCHAR WHEN s_nationkey > 5 THEN '0.0' END FROM supplier
      UNION ALL SELECT 'summary', (SELECT count(*) FROM customer)::VARCHAR, (SELECT count(*) FROM part)::VARCHAR,
        (SELECT count(*) FROM part WHERE p_size > 20)::VARCHAR""",
    "mapping_export": """SELECT row_number() OVER (ORDER BY CASE WHEN s_nationkey > 12 THEN s_nationkey / 32.0
        WHEN s_nationkey > 5 THEN 0.0 END DESC NULLS LAST, s_name) AS place, s_name AS raw FROM supplier""",
    "tab_export": f"""SELECT 'Startups' AS tab, 'https://c.example/' || c_custkey AS a, c_name AS b, c_nationkey::VARCHAR AS c FROM customer
      UNION ALL SELECT 'Products', 'https://p.example/' || p_partkey, p_name, coalesce({_PRICING}, '') FROM part
      UNION ALL SELECT 'Research Papers', 'https://d.example/' || doc_id,
        CASE WHEN lang <> 'es' THEN upper(lang) || ', ' || source || ', Li' ELSE '' END, coalesce(quality::VARCHAR, '')
      FROM documents LEFT JOIN labels USING (doc_id)
      UNION ALL SELECT 'Jobs', 'https://j.example/' || o_orderkey, 'Co ' || o_custkey,
        CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE '' END FROM orders
      UNION ALL SELECT 'News', 'https://n.example/' || doc_id, source, CASE WHEN lang = 'de' THEN '2024-02-01T00:00:00Z' ELSE '' END FROM documents
      UNION ALL SELECT 'Entity Mapping Log', s_name, upper(s_name),
        CASE WHEN s_nationkey > 12 THEN (s_nationkey / 32.0)::DOUBLE::VARCHAR WHEN s_nationkey > 5 THEN '0.0' ELSE '' END FROM supplier""",
    "resolved_store": """WITH k AS (SELECT c_nationkey % 4 AS k FROM customer)
      SELECT 'exact_canonical' AS method, count(*) AS records FROM k WHERE k = 0
      UNION ALL SELECT 'exact_alias', count(*) FROM k WHERE k = 1 UNION ALL SELECT 'fuzzy', count(*) FROM k WHERE k = 2
      UNION ALL SELECT 'no_match', count(*) FILTER (k = 3) + (SELECT count(*) FROM part) FROM k
      UNION ALL SELECT 'OpenAI', count(*) FROM k WHERE k < 2 UNION ALL SELECT 'Anthropic', count(*) FROM k WHERE k = 2
      UNION ALL SELECT 'Qwzx Unheard Of', count(*) FROM k WHERE k = 3""",
    "backfilled_store": f"""WITH p AS (SELECT {_PRICING} AS pricing, p_partkey % 5 <> 0 AND p_partkey % 3 = 0 AND p_partkey % 7 <> 0 AS free FROM part)
      SELECT CASE WHEN pricing IS NULL AND free THEN 'FREE' ELSE pricing END AS pricing, count(*) AS n FROM p GROUP BY ALL
      UNION ALL SELECT 'attempted', count(*) FROM p WHERE pricing IS NULL
      UNION ALL SELECT 'backfilled', count(*) FROM p WHERE pricing IS NULL AND free""",
    "enriched_store": """SELECT CASE WHEN lang = 'en' AND text <> '' THEN 'groq' ELSE 'none' END AS provider, count(*) AS n FROM documents GROUP BY ALL
      UNION ALL SELECT 'succeeded', count(*) FROM documents WHERE lang = 'en' AND text <> ''""",
    "company_snapshot": """SELECT CASE WHEN c_nationkey <> 7 THEN c_name ELSE '' END AS name,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(replace(c_name, '#', '-')) END AS slug,
        CASE WHEN c_nationkey > 3 THEN 'https://x.example/' || c_custkey END AS url,
        CASE WHEN c_acctbal > 0 THEN CAST(trunc(c_acctbal) AS BIGINT) END AS team_size, c_nationkey = 1 AS top_company FROM customer""",
    "feed_items": f"SELECT event_type AS source, title, link, props AS summary, raw_date FROM ({_FEEDS})",
    "feed_rejects": """SELECT event_type AS source, CASE event_type WHEN 'signup' THEN 'no body' ELSE 'unreadable entry' END AS reject_reason,
        count(*) AS n, CASE event_type WHEN 'view' THEN 1 END AS first_place
      FROM events WHERE event_type = 'signup' OR (event_type = 'view' AND event_id % 7 = 0) GROUP BY event_type""",
    "feed_union": f"""SELECT name AS source, title, link, props AS summary, raw_date FROM ({_FEEDS}) JOIN
        (VALUES {", ".join(f"('{n}', '{k}')" for n, k in zip(fv.FEEDS, ("click", "view", "purchase", "error")))}) f(name, kind)
        ON event_type = kind""",
    "feed_file_rejects": f"""SELECT '{list(fv.FEEDS)[1]}' AS source, 'cut-off entry' AS reject_reason, count(DISTINCT event_id // 2500) AS files,
        count(DISTINCT event_id // 2500)::BIGINT AS entries FROM events WHERE event_type = 'view'""",
}
