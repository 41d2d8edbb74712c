"""Queries over counts, summaries, search, and flat and display rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.catalog.tables import table, utc
from ledgerloom.operators.gram_index import GramIndex
from ledgerloom.operators.report import (
    count_by_type,
    flat_columns,
    matched_of_total,
    minute_text,
    pricing_badge,
    search,
    search_columns,
    search_predicate,
    short_authors,
    summary,
    two_decimals,
    yes_no,
)
from ledgerloom.operators.typed import judge_payloads
from ledgerloom.operators.validate import envelope, split_records
from ledgerloom.session import run_folder
from ledgerloom.sources.landed import payload_records

AT = "2024-02-01T00:00:00Z"


def record_counts(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").withColumnRenamed("role", "record_type")
    return count_by_type(turns, types=("assistant", "system", "tool", "user"))


def startup_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer")
    content = F.struct(
        F.col("c_name").alias("entityName"), F.struct(F.col("c_nationkey").cast("bigint").alias("employeeCount")).alias("data")
    )
    url = F.concat(F.lit("https://c.example/"), F.col("c_custkey").cast("string"))
    return rows.select(*envelope("STARTUP", F.col("c_mktsegment"), url, content, utc(AT)))


def product_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part")
    pricing = F.when(F.col("p_size") > 40, F.lit("FREE")).when(F.col("p_size") > 20, F.lit("PAID")).when(F.col("p_size") > 10, F.lit(""))
    content = F.struct(F.col("p_name").alias("startupName"), pricing.alias("pricingModel"))
    url = F.concat(F.lit("https://p.example/"), F.col("p_partkey").cast("string"))
    return rows.select(*envelope("PRODUCT", F.col("p_brand"), url, content, utc(AT)))


def paper_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    content = F.struct(
        F.col("source").alias("title"),
        F.when(F.col("lang") != "es", F.array(F.upper("lang"), F.col("source"), F.lit("Li"))).alias("authors"),
        F.concat(F.lit("https://d.example/"), F.col("doc_id").cast("string")).alias("paper_url"),
        F.lit(None).cast("string").alias("github_url"),
        F.col("quality").cast("bigint").alias("github_stars"),
        F.when(F.col("lang") == "en", utc(AT)).alias("published_date"),
    )
    return rows.select(*envelope("RESEARCH_PAPER", F.col("lang"), content["paper_url"], content, utc(AT)))


def job_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders")
    content = F.struct(
        F.concat(F.lit("Co "), F.col("o_custkey").cast("string")).alias("company"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("date"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True)).when(F.col("o_orderstatus") == "O", F.lit(False)).alias("is_remote"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("Engineering")).alias("role_family"),
    )
    url = F.concat(F.lit("https://j.example/"), F.col("o_orderkey").cast("string"))
    return rows.select(*envelope("JOB", F.col("o_orderpriority"), url, content, utc(AT)))


def news_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents")
    content = F.struct(
        F.col("source").alias("title"), F.when(F.col("lang") == "de", utc(AT)).alias("publishedDate"), F.col("text").alias("fullText")
    )
    url = F.concat(F.lit("https://n.example/"), F.col("doc_id").cast("string"))
    return rows.select(*envelope("NEWS", F.col("lang"), url, content, utc(AT)))


def mapping_records(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as mappings: a positive, zero or unknown confidence by country."""
    confidence = F.when(F.col("s_nationkey") > 12, F.col("s_nationkey") / 32.0).when(F.col("s_nationkey") > 5, F.lit(0.0))
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("raw_name"), F.upper("s_name").alias("canonical_name"), confidence.alias("confidence")
    )


def summary_counts(spark: SparkSession, sf: str) -> DataFrame:
    return summary(
        startup_records(spark, sf), product_records(spark, sf), paper_records(spark, sf),
        job_records(spark, sf), news_records(spark, sf), mapping_records(spark, sf),
    )


SEARCHES = {
    "STARTUP": (startup_records, "MER#0000000"),
    "PRODUCT": (product_records, "Ring"),
    "RESEARCH_PAPER": (paper_records, "fr src1"),
    "JOB": (job_records, "engin"),
    "NEWS": (news_records, "SRC1"),
    "MAPPING": (mapping_records, "plier#00000000"),
}


def search_counts(spark: SparkSession, sf: str) -> DataFrame:
    merged = None
    for tab, (records, query) in SEARCHES.items():
        found = matched_of_total(records(spark, sf), search_predicate(query, *search_columns()[tab]))
        part = found.select(F.lit(tab).alias("tab"), "matched", "total", "label")
        merged = part if merged is None else merged.unionByName(part)
    return merged


def search_rows(spark: SparkSession, sf: str) -> DataFrame:
    return search(paper_records(spark, sf), "RESEARCH_PAPER", "FR src1").select(F.col("source.url").alias("url"))


def search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Papers found through an index of grams: a long query, a rare one, one without a hit and one too short for the index."""
    papers = paper_records(spark, sf).select("source.url", "content.title", F.array_join("content.authors", " ").alias("authors"))
    index = GramIndex(spark, run_folder(spark, "grams"), {"title": F.col("title"), "authors": F.col("authors")}).build(papers, "url")
    found = None
    for query in ("FR src1", "src13", "no such text", "eN", "li"):
        own = index.search(query).select(F.lit(query).alias("query"), F.col("key").alias("url"))
        found = own if found is None else found.unionByName(own)
    return found


def _plain(df: DataFrame) -> DataFrame:
    """Flat rows under names without dots."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def flat_news(spark: SparkSession, sf: str) -> DataFrame:
    flat = _plain(news_records(spark, sf).select(*flat_columns("NEWS")))
    return flat.withColumn("fullText", F.md5("fullText"))


def flat_papers(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(paper_records(spark, sf).select(*flat_columns("RESEARCH_PAPER")))


def flat_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(job_records(spark, sf).select(*flat_columns("JOB")))


def flat_products(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(product_records(spark, sf).select(*flat_columns("PRODUCT")))


def flat_startups(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(startup_records(spark, sf).select(*flat_columns("STARTUP")))


def display_projection(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("text", " ")
    flag = F.when(F.col("role") == "user", F.lit(True)).when(F.col("role") == "assistant", F.lit(False))
    pricing = F.when(F.col("turn") == 0, F.lit("FREE")).when(F.col("turn") == 1, F.lit("ENTERPRISE")).when(F.col("turn") == 2, F.lit("FREEMIUM"))
    minute = F.when(F.col("turn") > 0, utc(AT) + F.make_dt_interval(mins=F.col("conv_id").cast("int")))
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        short_authors(words).alias("authors"),
        yes_no(flag).alias("remote"),
        pricing_badge(pricing).alias("badge"),
        minute_text(minute).alias("published"),
        two_decimals(F.when(F.col("turn") != 3, F.col("turn") / 8.0)).alias("confidence"),
    )


def payload_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Papers and jobs as JSON payloads in one table; the papers read back as typed records."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}

    def payloads(df: DataFrame, kind: str) -> DataFrame:
        return df.select(F.lit(kind).alias("record_type"), F.to_json(F.struct("*"), options).alias("payload"))

    rows = payloads(paper_records(spark, sf), "RESEARCH_PAPER").unionByName(payloads(job_records(spark, sf), "JOB"))
    content = F.col("content")
    return payload_records(rows, "RESEARCH_PAPER").select(
        F.col("source.url").alias("url"),
        F.array_join(content["authors"], "|").alias("authors"),
        content["github_stars"].alias("stars"),
        minute_text(content["published_date"]).alias("published"),
        minute_text(F.col("collectedAt")).alias("collected"),
    )


def record_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Products split by the schema; an empty pricing is not one of the allowed values."""
    valid, rejected = split_records(product_records(spark, sf), "PRODUCT", once=False)
    url = F.col("source.url").alias("url")
    return valid.select(url, F.lit("").alias("reasons")).unionByName(
        rejected.select(url, F.array_join("reject_reason", "; ").alias("reasons"))
    )


def typed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Stored JSON of four types with wrong types, missing members and broken text: ``record_type, id, payload``.

    Head counts of companies, flags of jobs, pricing of products and author lists of papers come in every right and wrong type.
    """

    def payload(source: DataFrame, kind: str, key: str, url: Column, content: Column) -> DataFrame:
        text = F.concat(
            F.lit('{"recordType": "' + kind + '", "source": {"name": "s", "url": '), url, F.lit('}, "content": '), content,
            F.lit(', "collectedAt": "2024-02-01T00:00:00Z", "note": 1}'),
        )
        return source.select(F.lit(kind).alias("record_type"), F.col(key).cast("long").alias("id"), text.alias("payload"), F.col(key).alias("_k"))

    at = lambda key, forms: F.element_at(F.array(*[F.lit(f) for f in forms]), (F.col(key) % len(forms) + 1).cast("int"))
    url = lambda key: F.concat(F.lit('"https://x.example/'), F.col(key).cast("string"), F.lit('"'))
    companies = payload(
        table(spark, sf, "customer"), "STARTUP", "c_custkey", url("c_custkey"),
        F.concat(F.lit('{"entityName": "A", "data": '), at("c_custkey", COUNT_FORMS), F.lit("}")),
    )
    products = payload(
        table(spark, sf, "part"), "PRODUCT", "p_partkey", F.when(F.col("p_size") > 45, F.lit('"nowhere"')).otherwise(url("p_partkey")),
        F.concat(at("p_partkey", NAME_FORMS), at("p_size", PRICING_FORMS), F.lit("}")),
    )
    jobs = payload(
        table(spark, sf, "orders"), "JOB", "o_orderkey", url("o_orderkey"),
        F.concat(F.lit('{"company": "C", "is_remote": '), at("o_orderkey", REMOTE_FORMS), F.lit(', "date": '), at("o_custkey", DATE_FORMS), F.lit("}")),
    )
    papers = payload(
        table(spark, sf, "documents"), "RESEARCH_PAPER", "doc_id", url("doc_id"),
        F.concat(F.lit('{"title": "T", "paper_url": "https://p.example", "authors": '), at("doc_id", AUTHOR_FORMS), F.lit("}")),
    )
    rows = companies.unionByName(products).unionByName(jobs).unionByName(papers)
    cut = F.when(F.col("_k") % 11 == 10, F.expr("left(payload, length(payload) - 2)")).otherwise(F.col("payload"))
    return rows.select("record_type", "id", cut.alias("payload"))


def payload_types(spark: SparkSession, sf: str) -> DataFrame:
    """Every payload judged: a row per fault with its path and reason, or one row with the typed value of a valid record."""
    rows = typed_payloads(spark, sf)
    values = {
        "STARTUP": F.col("record.content.data.employeeCount").cast("string"),
        "PRODUCT": F.col("record.content.pricingModel"),
        "JOB": F.concat_ws("|", F.col("record.content.is_remote").cast("string"), F.date_format("record.content.date", "yyyy-MM-dd HH:mm")),
        "RESEARCH_PAPER": F.array_join("record.content.authors", "|"),
    }
    judged = None
    for kind, value in values.items():
        own = judge_payloads(rows.where(F.col("record_type") == kind), kind)
        valid = F.array(F.struct(F.lit("").alias("path"), F.lit("valid").alias("reason")))
        own = own.select("record_type", "id", F.explode(F.when(F.size("rejects") > 0, F.col("rejects")).otherwise(valid)).alias("f"), F.coalesce(value, F.lit("")).alias("value"))
        judged = own if judged is None else judged.unionByName(own)
    return judged.select("record_type", "id", "f.path", "f.reason", "value")


# JSON of each form, and what is read from it: a value, or none with a reason.
COUNT_FORMS = ('{"employeeCount": 5}', '{"employeeCount": "many"}', '{"employeeCount": "12"}', '{"employeeCount": 3.0}', '{"employeeCount": 2.5}',
               '{"employeeCount": null}', "{}", '{"employeeCount": true}', '{"employeeCount": [1]}', '{"employeeCount": 1e30}', "7", "null")
COUNT_READ = (("5", 0), ("", 1), ("12", 0), ("3", 0), ("", 1), ("", 0), ("", 0), ("1", 0), ("", 1), ("", 1), ("", 2), ("", 2))
NAME_FORMS = ('{"startupName": "P", "pricingModel": ', '{"startupName": 5, "pricingModel": ', '{"startupName": null, "pricingModel": ', '{"pricingModel": ')
NAME_READ = ("", "not a text", "missing", "missing")
PRICING_FORMS = ('"FREE"', '"CHEAP"', "null", "1")
PRICING_READ = (("FREE", ""), ("", "not an allowed value"), ("", ""), ("", "not an allowed value"))
REMOTE_FORMS = ("true", "false", "5", "1", "0.0", '"YES"', '"maybe"', "null", "[]")
REMOTE_READ = (("true", 0), ("false", 0), ("", 1), ("true", 0), ("false", 0), ("true", 0), ("", 1), ("", 0), ("", 1))
DATE_FORMS = ('"2024-01-02T03:04:00Z"', "null", "17", '"soon"', '"2024-01-02T05:04:00+02:00"')
DATE_READ = (("2024-01-02 03:04", 0), ("", 0), ("", 1), ("", 1), ("2024-01-02 03:04", 0))
AUTHOR_FORMS = ('["A", "B"]', "[]", '["A", 1]', '["A", null]', '"A"', "null", '["C"]')
AUTHOR_READ = (("A|B", 0), ("", 0), ("", 1), ("", 1), ("", 1), ("", 1), ("C", 0))


def _sql_pick(key: str, values: list) -> str:
    """The entry of a list that a key chooses."""
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"list_extract([{listed}], (1 + {key} % {len(values)})::BIGINT)"


def _sql_judged() -> str:
    """record_type, id, the faults in rule order as path and reason, and the typed value."""
    first, second = (lambda forms: [f[0] for f in forms]), (lambda forms: [f[1] for f in forms])
    fault = lambda test, path, reason: f"CASE WHEN {test} THEN {{'path': {path}, 'reason': {reason}}} END"
    count = _sql_pick("c_custkey", second(COUNT_READ))
    name, pricing = _sql_pick("p_partkey", list(NAME_READ)), _sql_pick("p_size", second(PRICING_READ))
    remote, date = _sql_pick("o_orderkey", second(REMOTE_READ)), _sql_pick("o_custkey", second(DATE_READ))
    author = _sql_pick("doc_id", second(AUTHOR_READ))
    flag, day = _sql_pick("o_orderkey", first(REMOTE_READ)), _sql_pick("o_custkey", first(DATE_READ))
    parts = (
        ("STARTUP", "customer", "c_custkey", [
            fault(f"{count} = 2", "'$.content.data'", "'not an object'"), fault(f"{count} = 1", "'$.content.data.employeeCount'", "'not a whole number'"),
        ], _sql_pick("c_custkey", first(COUNT_READ))),
        ("PRODUCT", "part", "p_partkey", [
            fault("p_size > 45", "'$.source.url'", "'not a URL'"), fault(f"{name} <> ''", "'$.content.startupName'", name),
            fault(f"{pricing} <> ''", "'$.content.pricingModel'", pricing),
        ], _sql_pick("p_size", first(PRICING_READ))),
        ("JOB", "orders", "o_orderkey", [
            fault(f"{date} = 1", "'$.content.date'", "'not an ISO time'"), fault(f"{remote} = 1", "'$.content.is_remote'", "'not true or false'"),
        ], f"concat_ws('|', nullif({flag}, ''), nullif({day}, ''))"),
        ("RESEARCH_PAPER", "documents", "doc_id", [fault(f"{author} = 1", "'$.content.authors'", "'not a list of texts'")], _sql_pick("doc_id", first(AUTHOR_READ))),
    )
    return " UNION ALL ".join(
        f"""SELECT '{kind}' AS record_type, {key}::BIGINT AS id, CASE WHEN {key} % 11 = 10 THEN [{{'path': '$', 'reason': 'broken JSON'}}]
          ELSE list_filter([{", ".join(faults)}], lambda x: x IS NOT NULL) END AS faults, {value} AS value FROM {source}"""
        for kind, source, key, faults, value in parts
    )


_AT_ISO = "2024-02-01T00:00:00Z"

QUERIES = {
    "payload_scan": payload_scan,
    "record_validation": record_validation,
    "payload_types": payload_types,
    "record_counts": record_counts,
    "summary_counts": summary_counts,
    "search_counts": search_counts,
    "search_rows": search_rows,
    "search_indexed": search_indexed,
    "flat_export": flat_news,
    "flat_papers": flat_papers,
    "flat_jobs": flat_jobs,
    "flat_products": flat_products,
    "flat_startups": flat_startups,
    "display_projection": display_projection,
}

ORACLE = {
    "payload_types": f"""SELECT record_type, id, unnest(CASE WHEN len(faults) = 0 THEN [{{'path': '', 'reason': 'valid'}}] ELSE faults END, recursive := true),
        CASE WHEN len(faults) = 0 THEN value ELSE '' END AS value FROM ({_sql_judged()})""",
    "payload_scan": """SELECT 'https://d.example/' || doc_id AS url,
        CASE WHEN lang <> 'es' THEN upper(lang) || '|' || source || '|Li' END AS authors, quality::BIGINT AS stars,
        CASE WHEN lang = 'en' THEN '2024-02-01 00:00' ELSE '' END AS published, '2024-02-01 00:00' AS collected
      FROM documents LEFT JOIN labels USING (doc_id)""",
    "record_validation": """SELECT 'https://p.example/' || p_partkey AS url,
        CASE WHEN p_size BETWEEN 11 AND 20 THEN 'pricingModel is not allowed' ELSE '' END AS reasons FROM part""",
    "record_counts": """SELECT k.record_type, count(conv_id) AS n FROM (VALUES ('assistant'), ('system'), ('tool'), ('user')) k(record_type)
      LEFT JOIN conversations ON role = k.record_type GROUP BY k.record_type""",
    "summary_counts": """SELECT (SELECT count(*) FROM customer) AS startups, (SELECT count(*) FROM part) AS products,
        (SELECT count(*) FROM documents) AS papers,
        (SELECT count(*) FROM documents JOIN labels USING (doc_id) WHERE quality <> 0) AS "papersWithGithubStars",
        (SELECT count(*) FROM orders) AS jobs, (SELECT count(*) FROM documents) AS news,
        (SELECT count(*) FROM part WHERE p_size > 20) AS "productsWithPricing",
        (SELECT count(*) FROM supplier WHERE s_nationkey > 12) AS "entityMappingsResolved",
        (SELECT count(*) FROM supplier) AS "entityMappingsTotal" """,
    "search_counts": """SELECT tab, matched, total, matched || ' of ' || total AS label FROM (
        SELECT 'STARTUP' AS tab, count(*) FILTER (contains(lower(c_name), 'mer#0000000')) AS matched, count(*) AS total FROM customer
        UNION ALL SELECT 'PRODUCT', count(*) FILTER (contains(lower(p_name), 'ring')), count(*) FROM part
        UNION ALL SELECT 'RESEARCH_PAPER', count(*) FILTER (lang = 'fr' AND source LIKE 'src1%'), count(*) FROM documents
        UNION ALL SELECT 'JOB', count(*) FILTER (o_orderpriority = '2-HIGH'), count(*) FROM orders
        UNION ALL SELECT 'NEWS', count(*) FILTER (contains(source, 'src1')), count(*) FROM documents
        UNION ALL SELECT 'MAPPING', count(*) FILTER (contains(lower(s_name), 'plier#00000000')), count(*) FROM supplier)""",
    "search_rows": """SELECT 'https://d.example/' || doc_id AS url FROM documents WHERE lang = 'fr' AND source LIKE 'src1%'""",
    "search_indexed": """SELECT q AS query, 'https://d.example/' || doc_id AS url FROM documents,
        (VALUES ('FR src1'), ('src13'), ('no such text'), ('eN'), ('li')) v(q)
      WHERE contains(lower(source), lower(q)) OR contains(lower(CASE WHEN lang <> 'es' THEN upper(lang) || ' ' || source || ' Li' ELSE '' END), lower(q))""",
    "flat_export": f"""SELECT '1.0' AS "schemaVersion", 'NEWS' AS "recordType", lang AS source_name,
        'https://n.example/' || doc_id AS source_url, source AS title,
        CASE WHEN lang = 'de' THEN '{_AT_ISO}' ELSE '' END AS "publishedDate",
        md5(CASE WHEN length(text) > 5000 THEN left(text, 5000) || '... [truncated]' ELSE coalesce(text, '') END) AS "fullText",
        '{_AT_ISO}' AS "collectedAt" FROM documents""",
    "flat_papers": f"""SELECT '1.0' AS "schemaVersion", 'RESEARCH_PAPER' AS "recordType", lang AS source_name,
        'https://d.example/' || doc_id AS source_url, source AS title,
        CASE WHEN lang <> 'es' THEN upper(lang) || ', ' || source || ', Li' ELSE '' END AS authors,
        'https://d.example/' || doc_id AS paper_url, '' AS github_url, coalesce(quality::VARCHAR, '') AS github_stars,
        CASE WHEN lang = 'en' THEN '{_AT_ISO}' ELSE '' END AS published_date, '{_AT_ISO}' AS "collectedAt"
      FROM documents LEFT JOIN labels USING (doc_id)""",
    "flat_jobs": f"""SELECT '1.0' AS "schemaVersion", 'JOB' AS "recordType", o_orderpriority AS source_name,
        'https://j.example/' || o_orderkey AS source_url, 'Co ' || o_custkey AS company,
        CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS date,
        CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE '' END AS is_remote,
        CASE WHEN o_orderpriority = '2-HIGH' THEN 'Engineering' ELSE '' END AS role_family, '{_AT_ISO}' AS "collectedAt" FROM orders""",
    "flat_products": f"""SELECT '1.0' AS "schemaVersion", 'PRODUCT' AS "recordType", p_brand AS source_name,
        'https://p.example/' || p_partkey AS source_url, p_name AS "startupName",
        CASE WHEN p_size > 40 THEN 'FREE' WHEN p_size > 20 THEN 'PAID' ELSE '' END AS "pricingModel", '{_AT_ISO}' AS "collectedAt" FROM part""",
    "flat_startups": f"""SELECT '1.0' AS "schemaVersion", 'STARTUP' AS "recordType", c_mktsegment AS source_name,
        'https://c.example/' || c_custkey AS source_url, c_name AS "entityName", c_nationkey::VARCHAR AS "employeeCount",
        '{_AT_ISO}' AS "collectedAt" FROM customer""",
    "display_projection": f"""SELECT conv_id, turn, array_to_string(w[1:2], ', ') || CASE WHEN len(w) > 2 THEN ' +' || (len(w) - 2) ELSE '' END AS authors,
        CASE role WHEN 'user' THEN 'Yes' WHEN 'assistant' THEN 'No' ELSE '{fv.DASH}' END AS remote,
        CASE turn WHEN 0 THEN 'free' WHEN 1 THEN 'paid' WHEN 2 THEN 'free' ELSE '{fv.DASH}' END AS badge,
        CASE WHEN turn > 0 THEN strftime(TIMESTAMP '2024-02-01' + INTERVAL 1 MINUTE * conv_id, '%Y-%m-%d %H:%M') ELSE '' END AS published,
        CASE WHEN turn <> 3 THEN format('{{:.2f}}', CAST(CAST(turn / 8.0 AS DECIMAL(18, 3)) + 0.0001 AS DOUBLE)) ELSE '{fv.DASH}' END AS confidence
      FROM (SELECT *, string_split(text, ' ') AS w FROM conversations)""",
}
