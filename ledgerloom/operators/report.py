"""Counts, summaries, review lists, search, and flat and display projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.dates import iso_utc
from ledgerloom.functions.text import empty_to_null, truncate_cell
from ledgerloom.operators.ranking import top_rows
from ledgerloom.sources.seeds import labels


def count_by_type(records: DataFrame, column: str = "record_type", types: Sequence[str] = fv.RECORD_TYPES) -> DataFrame:
    """Rows per type; every known type appears, with 0 if it has none."""
    known = labels(records.sparkSession, column, types)
    counts = records.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return known.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def truthy(value: Column) -> Column:
    """A number other than 0; null does not count."""
    return F.coalesce(value, F.lit(0)) != 0


def metrics_row(parts: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """One row of named counts from one-row aggregates, each of them read once."""
    long = None
    for part in parts:
        pairs = part.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in part.columns]))
        ).select("col.*")
        long = pairs if long is None else long.unionByName(pairs)
    return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


SUMMARY_NAMES = (
    "startups", "products", "papers", "papersWithGithubStars", "jobs", "news",
    "productsWithPricing", "entityMappingsResolved", "entityMappingsTotal",
)


def summary(
    startups: DataFrame, products: DataFrame, papers: DataFrame, jobs: DataFrame, news: DataFrame, mappings: DataFrame
) -> DataFrame:
    """The nine snapshot counts in one row."""
    rows = F.count(F.lit(1))
    pricing = empty_to_null(F.col("content.pricingModel"))
    return metrics_row(
        [
            startups.agg(rows.alias("startups")),
            products.agg(rows.alias("products"), F.count_if(pricing.isNotNull()).alias("productsWithPricing")),
            papers.agg(
                rows.alias("papers"), F.count_if(truthy(F.col("content.github_stars"))).alias("papersWithGithubStars")
            ),
            jobs.agg(rows.alias("jobs")),
            news.agg(rows.alias("news")),
            mappings.agg(
                F.count_if(F.coalesce(F.col("confidence"), F.lit(0.0)) > 0).alias("entityMappingsResolved"),
                rows.alias("entityMappingsTotal"),
            ),
        ],
        SUMMARY_NAMES,
    )


def category_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label and their share of the largest label in whole percent, largest first."""
    value = F.coalesce(empty_to_null(F.col(label)), F.lit(fv.UNCLASSIFIED))
    counts = df.groupBy(value.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    largest = counts.select(F.max("n")).scalar()
    share = F.round(F.col("n") / largest * 100, 0).cast("int")
    return counts.withColumn("share_of_max", share).orderBy(F.desc("n"), "label")


def search_predicate(query: str, *columns: Column) -> Column:
    """True when one of the texts contains the query, ignoring case; null counts as empty."""
    found = F.lit(False)
    for column in columns:
        found = found | F.lower(F.coalesce(column, F.lit(""))).contains(query.lower())
    return found


# Columns that are searched per export tab.
def search_columns() -> dict[str, list[Column]]:
    authors = F.array_join(F.coalesce(F.col("content.authors"), F.array().cast("array<string>")), " ")
    return {
        "STARTUP": [F.col("content.entityName")],
        "PRODUCT": [F.col("content.startupName")],
        "RESEARCH_PAPER": [F.col("content.title"), authors],
        "JOB": [F.col("content.company"), F.col("content.role_family")],
        "NEWS": [F.col("content.title")],
        "MAPPING": [F.col("raw_name"), F.col("canonical_name")],
    }


def search(df: DataFrame, tab: str, query: str) -> DataFrame:
    return df.where(search_predicate(query, *search_columns()[tab]))


def matched_of_total(df: DataFrame, match: Column) -> DataFrame:
    """``n of total`` in one pass."""
    counts = df.agg(F.count_if(match).alias("matched"), F.count(F.lit(1)).alias("total"))
    return counts.withColumn("label", F.concat_ws(" of ", F.col("matched").cast("string"), F.col("total").cast("string")))


def changed_mappings(mappings: DataFrame) -> DataFrame:
    return mappings.where(F.col("canonical_name") != F.col("raw_name"))


def resolved_mappings(mappings: DataFrame) -> DataFrame:
    return mappings.where(F.col("confidence") > 0)


def by_confidence(mappings: DataFrame, *ties: str) -> DataFrame:
    """All mappings, most certain first; the name and then ``ties`` settle the rest.

    Give a column that differs between records of one name, so that the sort can split a name that
    many records share.
    """
    return mappings.orderBy(F.desc("confidence"), "raw_name", *ties)


def review_list(mappings: DataFrame, rows: int = fv.REVIEW_ROWS) -> DataFrame:
    """The least certain changed names."""
    order = [F.col(c).asc() for c in ("confidence", "raw_name", "canonical_name")]
    return top_rows(changed_mappings(mappings), order, rows)


def or_empty(value: Column) -> Column:
    """The value as text, or empty; false and 0 stay."""
    return F.coalesce(value.cast("string"), F.lit(""))


def _time(value: Column) -> Column:
    return F.coalesce(iso_utc(value), F.lit(""))


def flat_columns(record_type: str) -> list[Column]:
    """The flat row of a record type, in export column order."""
    content = F.col("content")
    head = [
        or_empty(F.col("schemaVersion")).alias("schemaVersion"),
        or_empty(F.col("recordType")).alias("recordType"),
        or_empty(F.col("source.name")).alias("source.name"),
        or_empty(F.col("source.url")).alias("source.url"),
    ]
    body = {
        "STARTUP": lambda: [
            or_empty(content["entityName"]).alias("entityName"),
            or_empty(content["data"]["employeeCount"]).alias("employeeCount"),
        ],
        "PRODUCT": lambda: [
            or_empty(content["startupName"]).alias("startupName"),
            or_empty(content["pricingModel"]).alias("pricingModel"),
        ],
        "RESEARCH_PAPER": lambda: [
            or_empty(content["title"]).alias("title"),
            F.coalesce(F.array_join(content["authors"], ", "), F.lit("")).alias("authors"),
            or_empty(content["paper_url"]).alias("paper_url"),
            or_empty(content["github_url"]).alias("github_url"),
            or_empty(content["github_stars"]).alias("github_stars"),
            _time(content["published_date"]).alias("published_date"),
        ],
        "JOB": lambda: [
            or_empty(content["company"]).alias("company"),
            _time(content["date"]).alias("date"),
            or_empty(content["is_remote"]).alias("is_remote"),
            or_empty(content["role_family"]).alias("role_family"),
        ],
        "NEWS": lambda: [
            or_empty(content["title"]).alias("title"),
            _time(content["publishedDate"]).alias("publishedDate"),
            truncate_cell(content["fullText"]).alias("fullText"),
        ],
    }
    return [*head, *body[record_type](), _time(F.col("collectedAt")).alias("collectedAt")]


def pricing_badge(pricing: Column) -> Column:
    return (
        F.when(F.coalesce(pricing, F.lit("")) == "", F.lit(fv.DASH))
        .when(pricing.isin("FREE", "FREEMIUM"), F.lit("free"))
        .otherwise(F.lit("paid"))
    )


def short_authors(authors: Column) -> Column:
    """The first two names, and how many more there are."""
    names = F.coalesce(authors, F.array().cast("array<string>"))
    more = F.when(F.size(names) > 2, F.concat(F.lit(" +"), (F.size(names) - 2).cast("string"))).otherwise(F.lit(""))
    return F.concat(F.array_join(F.slice(names, 1, 2), ", "), more)


def minute_text(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit(""))


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).when(~flag, F.lit("No")).otherwise(F.lit(fv.DASH))


def two_decimals(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.2f", value)).otherwise(F.lit(fv.DASH))
