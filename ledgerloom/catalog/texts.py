"""Queries over text, URL, HTML and answer expressions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.catalog.tables import SQL_LEFT, SQL_RIGHT, sql_bars, sql_chunk, table
from ledgerloom.functions.answers import answer_text, json_object, strip_fences, valid_enum, variant_string
from ledgerloom.functions.html import ENTITIES, TAG_COST, dense_text, main_text
from ledgerloom.functions.text import (
    build_prompt,
    chunk_text,
    is_relevant,
    label_by_keywords,
    label_by_patterns,
    normalize_name,
    remote_flag,
    truncate_cell,
)
from ledgerloom.functions.urls import (
    canonical_url,
    dedup_key,
    last_path_segment,
    owner_repo,
    paper_short_id,
    repo_url,
)
from ledgerloom.operators.dedup import first_per_key
from ledgerloom.operators.report import category_counts

BUDGET = 1000

PART_RULES = (
    (("ring", "gear"), "Round"),
    (("bolt", "screw", "nut"), "Fastener"),
    (("widget", "small "), "Misc"),
)
WORD_RULES = (
    (r"\beauxche\b|\bqueque\b", "FR-RARE"),
    (r"\b(und|nicht)\b", "DE"),
    (r"\bpour\b", "FR"),
    (r"\bthe\b", "EN"),
)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def relevance_filter(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).where(is_relevant(F.col("source"), F.col("text"))).select("doc_id", "lang")


def keyword_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(label_by_keywords(F.col("p_name"), PART_RULES).alias("family"))
    return category_counts(parts, "family")


def pattern_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    labelled = documents(spark, sf).select(label_by_patterns(F.col("text"), WORD_RULES).alias("kind"))
    return category_counts(labelled, "kind")


def relevant_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Keep the documents that are relevant anywhere in their text, label them, count the labels."""
    kept = documents(spark, sf).where(is_relevant(F.col("source"), F.col("text"), (*fv.TOPIC_PATTERNS, r"\bthe\b", r"\bpour\b")))
    return category_counts(kept.select(label_by_patterns(F.col("text"), WORD_RULES).alias("kind")), "kind")


def remote_flags(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    location = (
        F.when(kind == "view", F.concat(F.lit("Remote - "), F.col("props")))
        .when(kind == "error", F.lit("remotely"))
        .when(kind == "signup", F.lit(""))
        .when(kind == "click", F.lit("Berlin"))
    )
    explicit = F.when(kind == "purchase", F.get_json_object("props", "$.k").cast("int") >= 50)
    flag = remote_flag(location, explicit)
    return table(spark, sf, "events").select("event_id", flag.alias("is_remote"))


def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    bare = F.regexp_replace("url", r"[?#].*$", "")
    entry = F.concat(F.regexp_replace(bare, r"/+$", ""), F.lit("v"), (F.col("page_id") % 20).cast("string"), F.lit("/"))
    note = F.concat(
        F.lit("Code ("), F.lit("https://github.com/u-"), F.replace(last_path_segment(bare), F.lit("."), F.lit("-")), F.lit("/kit."),
        F.col("page_id").cast("string"), F.lit(".git), see "), F.col("url"),
    )
    parts = owner_repo(repo_url(note))
    return table(spark, sf, "pages").select(
        "page_id",
        last_path_segment(bare).alias("segment"),
        paper_short_id(entry).alias("short_id"),
        repo_url(note).alias("repo_url"),
        parts["owner"].alias("owner"),
        parts["repo"].alias("repo"),
        repo_url(F.col("url")).isNull().alias("no_repo"),
    )


def canonical_url_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The first page per site section; queries other than tracking parameters keep sections apart."""
    section = F.regexp_replace("url", r"/[0-9]+(\.html)?/?", "/")
    pages = table(spark, sf, "pages").select("page_id", canonical_url(section).alias("url"))
    return first_per_key(pages.withColumn("key", dedup_key(F.col("url"))), ["key"], "page_id").select("key", "page_id")


def page_main_text(spark: SparkSession, sf: str) -> DataFrame:
    text = main_text(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.length(text).alias("n_chars"), F.md5(text).alias("digest"))


def page_dense_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text by block density of every page, once as it is and once without the elements that name their article."""
    bare = F.regexp_replace("html", r"(?i)</?(article|main|section)\b[^>]*>", "")
    rows = table(spark, sf, "pages").select("page_id", F.explode(F.array(F.struct(F.lit("given").alias("form"), F.col("html")), F.struct(F.lit("bare").alias("form"), bare.alias("html")))).alias("p"))
    text = rows.select("page_id", "p.form", dense_text(F.col("p.html")).alias("text"))
    return text.select("page_id", "form", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def chunk_boundary(spark: SparkSession, sf: str) -> DataFrame:
    chunk = chunk_text(F.col("text"), BUDGET)
    return documents(spark, sf).select("doc_id", F.length(chunk).alias("n_chars"), F.md5(chunk).alias("digest"))


def prompt_build(spark: SparkSession, sf: str) -> DataFrame:
    prompt = build_prompt(F.col("text"), fv.PRICING_SCHEMA, BUDGET)
    return documents(spark, sf).select("doc_id", F.length(prompt).alias("n_chars"), F.md5(prompt).alias("digest"))


def cell_truncation(spark: SparkSession, sf: str) -> DataFrame:
    cell = truncate_cell(F.col("text"))
    return documents(spark, sf).select(
        "doc_id",
        F.length(cell).alias("n_chars"),
        F.md5(cell).alias("digest"),
        cell.endswith(fv.CELL_SUFFIX).alias("cut"),
    )


def name_normalise(spark: SparkSession, sf: str) -> DataFrame:
    endings = F.array(*[F.lit(e) for e in (", Inc.", ".ai", " & Co", " LLC", " Corp. Ltd")])
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lit("part").alias("kind"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind")
    )
    raw = F.concat(F.upper("name"), F.get(endings, (F.col("id") % 5).cast("int")))
    return parts.unionByName(suppliers).select("kind", "id", normalize_name(raw).alias("norm"))


def json_object_parse(spark: SparkSession, sf: str) -> DataFrame:
    form = F.col("event_id") % 8
    raw = (
        F.when(form == 0, F.col("props"))
        .when(form == 1, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
        .when(form == 2, F.expr("left(props, length(props) - 1)"))
        .when(form == 3, F.concat(F.col("props"), F.lit(" extra")))
        .when(form == 4, F.concat(F.lit("["), F.col("props"), F.lit("]")))
        .when(form == 5, F.concat(F.col("props"), F.lit("],[")))
        .when(form == 6, F.concat(F.lit("  ```\n"), F.col("props"), F.lit("```  ")))
        .otherwise(F.concat(F.lit("Sure! "), F.col("props")))
    )
    data = json_object(raw)
    return table(spark, sf, "events").select(
        "event_id",
        data.isNotNull().alias("is_object"),
        F.try_variant_get(data, "$.k", "bigint").alias("k"),
        F.length(strip_fences(raw)).alias("n_chars"),
    )


def enum_validation(spark: SparkSession, sf: str) -> DataFrame:
    """The event kind stands for an answer: allowed in any case, not allowed, a number, or null."""
    kind = F.col("event_type")
    value = (
        F.when(kind == "view", F.lit('" free "'))
        .when(kind == "click", F.lit('"Enterprise"'))
        .when(kind == "signup", F.lit('"SUBSCRIPTION"'))
        .when(kind == "purchase", F.get_json_object("props", "$.k"))
        .otherwise(F.lit("null"))
    )
    inner = F.concat(F.lit('{"pricingModel": '), value, F.lit("}"))
    body = F.to_json(F.struct(F.array(F.struct(F.struct(inner.alias("content")).alias("message"))).alias("choices")))
    answer = answer_text(body, fv.ANSWER_PATHS["groq"])
    return table(spark, sf, "events").select(
        "event_id", valid_enum(variant_string(json_object(answer), "pricingModel")).alias("pricing")
    )


def _sql_topic() -> str:
    """The topic patterns with word boundaries as the comparison engine spells them."""
    return "|".join(re.sub(r"\\b$", lambda _: SQL_RIGHT, re.sub(r"^\\b", lambda _: SQL_LEFT, p)) for p in fv.TOPIC_PATTERNS)


def _sql_word(words: str) -> str:
    return f"regexp_matches(text, '(?i){SQL_LEFT}({words}){SQL_RIGHT}')"


def _sql_kind(text: str = "text") -> str:
    rules = (("eauxche|queque", "FR-RARE"), ("und|nicht", "DE"), ("pour", "FR"), ("the", "EN"))
    cases = " ".join(f"WHEN {_sql_word(w)} THEN '{name}'" for w, name in rules)
    return f"CASE {cases} ELSE 'Unclassified' END"


def _sql_host() -> str:
    return "lower(regexp_extract(trim(url), '^[^:/?#]+://([^/?#]*)', 1))"


_STRIPPED_HTML = "regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')"
for _element in ("script", "style", "nav", "noscript", "head", "footer"):
    _STRIPPED_HTML = f"regexp_replace({_STRIPPED_HTML}, '(?is)<{_element}\\b[^>]*>.*?</{_element}>', ' ', 'g')"
_STRIPPED_HTML = f"regexp_replace({_STRIPPED_HTML}, '<[^>]*>', ' ', 'g')"
for _entity, _char in (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
    ("&apos;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
):
    _STRIPPED_HTML = f"replace({_STRIPPED_HTML}, '{_entity}', '{_char}')"

# The run of greatest sum is the greatest difference of two prefix sums.
_DENSE = "string_agg(token, ' ' ORDER BY i)"
for _entity, _char in ENTITIES:
    _DENSE = f"replace({_DENSE}, '{_entity}', '{_char.replace("'", "''")}')"
_DENSE_SQL = rf"""WITH p AS (SELECT page_id, 'given' AS form, html FROM pages UNION ALL
      SELECT page_id, 'bare', regexp_replace(html, '(?i)</?(article|main|section)\b[^>]*>', '', 'g') FROM pages),
    t AS (SELECT page_id, form, unnest(l) AS token, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, form, regexp_extract_all(html,
      '(?is)<!--.*?-->|<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>|</?[a-z!?][^>]*>|[^< 	
]+|<') AS l FROM p)),
    g AS (SELECT *, token = '<' OR token[1] <> '<' AS word FROM t),
    s AS (SELECT *, sum(CASE WHEN word THEN 1 ELSE -{TAG_COST} END) OVER w AS s FROM g WINDOW w AS (PARTITION BY page_id, form ORDER BY i)),
    b AS (SELECT *, coalesce(least(0, min(s) OVER w), 0) AS low FROM s WINDOW w AS (PARTITION BY page_id, form ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    e AS (SELECT page_id, form, i AS last, low FROM b WHERE s > low QUALIFY row_number() OVER (PARTITION BY page_id, form ORDER BY s - low DESC, i) = 1),
    r AS (SELECT e.page_id, e.form, last, coalesce(max(i) FILTER (s = low AND i < last), 0) AS before FROM e JOIN s USING (page_id, form) GROUP BY ALL),
    x AS (SELECT page_id, form, {_DENSE} AS text FROM r JOIN g USING (page_id, form) WHERE word AND i > before AND i <= last GROUP BY page_id, form)
  SELECT page_id, form, length(text)::INT AS n_chars, md5(text) AS digest FROM p LEFT JOIN x USING (page_id, form)"""

_PROMPT = (fv.PROMPT_HEAD + fv.PRICING_SCHEMA + fv.PROMPT_TEXT_MARK).replace("'", "''")
_BARE = "regexp_replace(url, '[?#].*$', '')"
_SEGMENT = f"list_extract(string_split(regexp_replace({_BARE}, '/+$', ''), '/'), -1)"

QUERIES = {
    "relevance_filter": relevance_filter,
    "keyword_label_counts": keyword_label_counts,
    "pattern_label_counts": pattern_label_counts,
    "relevant_label_counts": relevant_label_counts,
    "remote_flag": remote_flags,
    "url_parts": url_parts,
    "canonical_url_dedup": canonical_url_dedup,
    "page_main_text": page_main_text,
    "page_dense_text": page_dense_text,
    "chunk_boundary": chunk_boundary,
    "prompt_build": prompt_build,
    "cell_truncation": cell_truncation,
    "name_normalise": name_normalise,
    "json_object_parse": json_object_parse,
    "enum_validation": enum_validation,
}

ORACLE = {
    "page_dense_text": _DENSE_SQL,
    "relevance_filter": f"""SELECT doc_id, lang FROM documents
      WHERE regexp_matches(coalesce(source, '') || ' ' || coalesce(text, ''), '(?i){_sql_topic()}')""",
    "keyword_label_counts": sql_bars(
        """SELECT CASE WHEN contains(lower(p_name), 'ring') OR contains(lower(p_name), 'gear') THEN 'Round'
             WHEN contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'screw') OR contains(lower(p_name), 'nut')
               THEN 'Fastener'
             WHEN contains(lower(p_name), 'widget') OR contains(lower(p_name), 'small ') THEN 'Misc'
             ELSE 'Unclassified' END AS label FROM part"""
    ),
    "pattern_label_counts": sql_bars(f"SELECT {_sql_kind()} AS label FROM documents"),
    "relevant_label_counts": sql_bars(
        f"""SELECT {_sql_kind()} AS label FROM documents
        WHERE regexp_matches(coalesce(source, '') || ' ' || coalesce(text, ''), '(?i){_sql_topic()}|{SQL_LEFT}(the|pour){SQL_RIGHT}')"""
    ),
    "remote_flag": """SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'error' THEN false
        WHEN 'click' THEN false WHEN 'purchase' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50
        END AS is_remote FROM events""",
    "url_parts": f"""SELECT page_id, {_SEGMENT} AS segment, {_SEGMENT} AS short_id,
        'https://github.com/u-' || replace({_SEGMENT}, '.', '-') || '/kit.' || page_id || '.git' AS repo_url,
        'u-' || replace({_SEGMENT}, '.', '-') AS owner, 'kit.' || page_id AS repo, true AS no_repo
      FROM pages""",
    "canonical_url_dedup": f"""SELECT key, min(page_id) AS page_id FROM (SELECT page_id,
        regexp_replace(regexp_replace(regexp_replace({_sql_host()} || CASE WHEN rest LIKE '/%' THEN rest ELSE '/' || rest END,
          '#.*$', ''), '([?&])utm_[^&]*', '\\1', 'g'), '[?&]+$', '') AS key
      FROM (SELECT *, regexp_extract(url, '^[^:/?#]+://[^/?#]*(.*)$', 1) AS rest
        FROM (SELECT page_id, regexp_replace(trim(url), '/[0-9]+(\\.html)?/?', '/') AS url FROM pages))) GROUP BY key""",
    "page_main_text": f"""SELECT page_id, length(t) AS n_chars, md5(t) AS digest FROM (SELECT page_id,
        nullif(trim(regexp_replace({_STRIPPED_HTML}, '[ \\t\\r\\n]+', ' ', 'g')), '') AS t FROM pages)""",
    "chunk_boundary": f"SELECT doc_id, length(chunk) AS n_chars, md5(chunk) AS digest FROM ({sql_chunk("documents", BUDGET)})",
    "prompt_build": f"""SELECT doc_id, length(p) AS n_chars, md5(p) AS digest
      FROM (SELECT doc_id, '{_PROMPT}' || chunk AS p FROM ({sql_chunk("documents", BUDGET)}))""",
    "cell_truncation": """SELECT doc_id, length(c) AS n_chars, md5(c) AS digest, ends_with(c, '... [truncated]') AS cut
      FROM (SELECT doc_id, CASE WHEN length(text) > 5000 THEN left(text, 5000) || '... [truncated]'
        ELSE coalesce(text, '') END AS c FROM documents)""",
    "name_normalise": r"""SELECT kind, id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(raw),
          '\.(com|ai|io|dev|art|co)\b', '', 'g'),
          '\b(inc|incorporated|llc|ltd|limited|corp|corporation|co|company|pbc|plc)\b\.?', '', 'g'),
          '[.,\-_/&]', ' ', 'g'), '\s+', ' ', 'g')) AS norm
      FROM (SELECT kind, id, upper(name) || [', Inc.', '.ai', ' & Co', ' LLC', ' Corp. Ltd'][id % 5 + 1] AS raw
        FROM (SELECT 'part' AS kind, p_partkey AS id, p_name AS name FROM part
              UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier))""",
    "json_object_parse": """SELECT event_id, event_id % 8 IN (0, 1, 6) AS is_object,
        CASE WHEN event_id % 8 IN (0, 1, 6) THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
        length(props) + CASE event_id % 8 WHEN 2 THEN -1 WHEN 3 THEN 6 WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 7 THEN 6
          ELSE 0 END AS n_chars
      FROM events""",
    "enum_validation": """SELECT event_id, CASE event_type WHEN 'view' THEN 'FREE' WHEN 'click' THEN 'ENTERPRISE' END AS pricing
      FROM events""",
}
