"""The five ingest jobs. Each turns landed rows into one decision per key, in one plan.

``at`` is the collection time and ``now`` the run time; both are passed in, so a run that is
repeated gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.dates import normalize_date
from ledgerloom.functions.html import main_text
from ledgerloom.functions.text import (
    first_non_empty,
    is_relevant,
    pricing_label,
    remote_flag,
    role_family,
    source_label,
    strip,
)
from ledgerloom.functions.urls import company_profile_url
from ledgerloom.operators.dedup import exclude_seen, first_per_key, latest_per_key, require
from ledgerloom.operators.ingest import (
    ALREADY_SEEN,
    INVALID,
    IRRELEVANT,
    SAVED,
    decide,
    first_reason,
    firsts,
    freshness_reason,
    keys_to_mark,
    settle,
)
from ledgerloom.operators.lookups import linked_repo, repo_stars
from ledgerloom.operators.ranking import newest_first, prominence_topk, top_rows
from ledgerloom.operators.validate import checks, envelope, reject_reasons
from ledgerloom.session import written
from ledgerloom.sinks.store import Store

ENVELOPE_COLUMNS = ("schemaVersion", "recordType", "source", "content", "collectedAt")
# Types whose judged rejections are remembered as seen.
MARKS_REJECTED = {"STARTUP": False, "PRODUCT": False, "RESEARCH_PAPER": False, "NEWS": True, "JOB": True}


def invalid_reason(record_type: str) -> Column:
    """``invalid`` when the envelope breaks a schema rule. A required empty name was dropped before."""
    return F.when(F.coalesce(*checks(record_type)).isNotNull(), F.lit(INVALID))


def saved_records(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("outcome") == SAVED).select(*ENVELOPE_COLUMNS)


def startups(companies: DataFrame, seen: DataFrame, k: int, at: Column) -> DataFrame:
    """The ``k`` most prominent companies; those seen before use up their place."""
    top = prominence_topk(companies, "top_company", "team_size", k, "seq")
    url = company_profile_url(F.col("slug"), F.col("url"))
    rows = require(top, "name").withColumn("url", url)
    content = F.struct(
        F.col("name").alias("entityName"), F.struct(F.col("team_size").alias("employeeCount")).alias("data")
    )
    enveloped = rows.select(
        "url", "seq", *envelope("STARTUP", F.lit(fv.STARTUP_SOURCE), F.col("url"), content, at)
    )
    return decide(enveloped, seen, "url", ["seq"], invalid_reason("STARTUP"))


def pricing_text(tagline: Column, description: Column) -> Column:
    return F.concat_ws(" ", tagline, description)


def products(posts: DataFrame, seen: DataFrame, k: int, at: Column) -> DataFrame:
    """The first ``k`` new valid products in feed order, with the ``raw_text`` behind each.

    Only new rows use up the quota; rows after the ``k``-th are left for a later run.
    """
    fields = ["url", "seq", "name", "tagline", "description", "makers"]
    named = firsts(require(posts, "url", "name").select(*fields), seen, "url", ["seq"])
    maker = F.get(F.col("makers.name"), F.lit(0))
    text = pricing_text(F.col("tagline"), F.col("description"))
    content = F.struct(
        first_non_empty(maker, F.col("name")).alias("startupName"), pricing_label(text).alias("pricingModel")
    )
    enveloped = named.select(
        "url",
        "seq",
        text.alias("raw_text"),
        "copies",
        "_seen",
        *envelope("PRODUCT", F.lit(fv.PRODUCT_SOURCE), F.col("url"), content, at),
    )
    decisions = settle(enveloped, invalid_reason("PRODUCT"))
    return top_rows(decisions.where(F.col("outcome") == SAVED), [F.col("seq").asc()], k)


def papers(
    entries: DataFrame, seen: DataFrame, index: DataFrame, stats: DataFrame, k: int, at: Column
) -> DataFrame:
    """The newest ``k`` papers that were not seen, with linked repository and its stars."""
    newest = newest_first(entries, "published", k, "entry_id")
    fresh = exclude_seen(
        first_per_key(require(newest, "entry_id").withColumnRenamed("entry_id", "url"), ["url"], "published"),
        seen,
        "url",
    )
    linked = linked_repo(fresh, index, "url", "comment", "summary")
    starred = repo_stars(linked, stats, "github_url", "url")
    content = F.struct(
        strip(F.col("title")).alias("title"),
        F.coalesce(F.col("authors.name"), F.array().cast("array<string>")).alias("authors"),
        F.col("url").alias("paper_url"),
        "github_url",
        "github_stars",
        F.col("published").alias("published_date"),
    )
    enveloped = starred.select("url", *envelope("RESEARCH_PAPER", F.lit(fv.PAPER_SOURCE), F.col("url"), content, at))
    reason = F.coalesce(invalid_reason("RESEARCH_PAPER"), F.lit(SAVED))
    return enveloped.withColumn("outcome", reason).withColumn("copies", F.lit(1))


def news(
    items: DataFrame,
    seen: DataFrame,
    pages: DataFrame,
    now: Column,
    at: Column,
    landing: Sequence[str] = ("source", "seq"),
    page_order: str | None = None,
) -> DataFrame:
    """Relevant items that are fresh or have no date.

    ``items`` has ``source, title, link, summary, raw_date, seq``, and ``landing`` names the columns
    that give its order; ``pages`` has ``url, html`` and is read for saved items only. Of several landed
    pages of a URL the last one by ``page_order`` counts.

    Copies go first; relevance and dates are worked out once per key, and relevance only of new keys.
    The decisions are written once, for the pages and the result both start from them.
    """
    rows = require(items.withColumnRenamed("link", "url"), "url")
    order = F.struct(*[F.col(c) for c in landing])
    narrow = rows.select("url", order.alias("landing"), "source", "title", "summary", "raw_date")
    single = firsts(narrow, seen, "url", ["landing"])
    relevant = F.when(~F.col("_seen"), is_relevant(F.col("title"), F.col("summary")))
    judged = single.withColumn("_relevant", relevant)
    dated = judged.withColumn("published", normalize_date(F.col("raw_date"), now))
    reason = first_reason(
        F.when(~F.col("_relevant"), F.lit(IRRELEVANT)), freshness_reason(F.col("published"), now, dateless="keep")
    )
    kept = settle(dated, reason).select("url", "source", "title", "published", "copies", "outcome")
    decisions = written(kept, "news-decisions")
    wanted = decisions.where(F.col("outcome") == SAVED).select("url")
    landed = pages.join(wanted, "url", "left_semi")
    latest = latest_per_key(landed, ["url"], *([page_order] if page_order else []), "html")
    bodies = latest.select("url", main_text(F.col("html")).alias("_body"))
    content = F.struct("title", F.col("published").alias("publishedDate"), F.col("_body").alias("fullText"))
    return decisions.withColumnRenamed("source", "feed").join(bodies, "url", "left").select(
        "url", "outcome", "copies", *envelope("NEWS", F.col("feed"), F.col("url"), content, at)
    )


def jobs(listings: DataFrame, seen: DataFrame, now: Column, at: Column) -> DataFrame:
    """Fresh jobs; stale ones and those without a date are dropped and remembered, those with an unreadable one dropped and reported.

    ``listings`` are the rows of ``board_jobs``.
    """
    landed = require(listings.withColumnRenamed("job_url", "url"), "url")
    if "raw_date" not in landed.columns:
        landed = landed.withColumn("raw_date", F.lit(None).cast("string"))
    fields = ["url", "company", "platform", "seq", "title", "location", "remote", "published", "raw_date"]
    rows = firsts(landed.select(*fields), seen, "url", ["company", "seq"])
    content = F.struct(
        "company",
        F.col("published").alias("date"),
        remote_flag(F.col("location"), F.col("remote")).alias("is_remote"),
        role_family(F.col("title")).alias("role_family"),
    )
    label = source_label(F.col("company"), F.col("platform"))
    enveloped = rows.select("url", "copies", "_seen", "raw_date", *envelope("JOB", label, F.col("url"), content, at))
    reason = first_reason(
        freshness_reason(F.col("content.date"), now, dateless="drop", raw=F.col("raw_date")), invalid_reason("JOB")
    )
    return settle(enveloped, reason).drop("raw_date")


def rejections(decisions: DataFrame, record_type: str) -> DataFrame:
    """Keys that were judged and not saved, with the outcome and every schema rule they break."""
    reasons = reject_reasons(checks(record_type)) if record_type != "NEWS" else F.array().cast("array<string>")
    judged = decisions.where(~F.col("outcome").isin(SAVED, ALREADY_SEEN))
    return judged.select("url", "outcome", reasons.alias("reject_reason"))


def commit(store: Store, record_type: str, batch_id: int, decisions: DataFrame, at: Column) -> int:
    """Store the saved records of a batch and mark their keys; see ``Store.commit``."""
    marks_rejected = MARKS_REJECTED[record_type]
    if marks_rejected:  # two uses: the saved records and the rejected keys
        decisions = written(decisions, "decisions")
    rejected = decisions.where(F.col("outcome") != SAVED) if marks_rejected else decisions.where(F.lit(False))
    marked = keys_to_mark(rejected, "url", marks_rejected)
    return store.commit(record_type, batch_id, saved_records(decisions), marked, at)


def commit_products(store: Store, batch_id: int, decisions: DataFrame, at: Column) -> int:
    """Store products and the text behind each, which a later backfill reads."""
    kept = written(decisions, "products")
    store.append_raw_text(kept.select("url", "raw_text", F.lit(0).alias("seq")), batch_id)
    return commit(store, "PRODUCT", batch_id, kept, at)
