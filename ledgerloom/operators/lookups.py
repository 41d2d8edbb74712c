"""Lookups that add a value to records and keep every record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import first_non_empty
from ledgerloom.functions.urls import canonical_url, owner_repo, paper_short_id, repo_url
from ledgerloom.operators.skew import HOT_ROWS, lookup
from ledgerloom.session import written


def repo_stars(
    papers: DataFrame,
    stats: DataFrame,
    url: str,
    spread: str,
    min_hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``github_stars`` by owner and repository; an unknown repository gives null, not 0.

    Many papers may link the same repository, so hot repositories are salted. The papers are written
    once, as both their counts and the lookup use what was worked out for them.
    """
    parts = owner_repo(F.col(url))
    keyed = papers.withColumn("_repo", F.concat_ws("/", parts["owner"], parts["repo"]))
    keyed = keyed.withColumn("_repo", F.when(parts.isNotNull(), F.col("_repo")))
    unique = stats.groupBy(F.concat_ws("/", "owner", "repo").alias("_repo")).agg(
        F.max("stargazers_count").alias("github_stars")
    )
    # Papers without a repository would share one null key; each gets a key of its own instead.
    alone = F.concat(F.lit("#"), F.col(spread).cast("string"))
    keyed = written(keyed.withColumn("_linked", parts.isNotNull()).withColumn("_repo", F.coalesce("_repo", alone)), "repo-keys")
    counts = keyed.where("_linked").groupBy("_repo").agg(F.count(F.lit(1)).alias("_rows"))
    stars = counts.join(unique, "_repo")
    return lookup(keyed.drop("_linked"), stars, counts, "_repo", "_rows", F.col(spread), min_hot_rows).drop("_repo")


def linked_repo(papers: DataFrame, index: DataFrame, entry_id: str, comment: str, summary: str) -> DataFrame:
    """Add ``github_url``: from the index payload of the paper, else its comment, else its summary.

    ``index`` has ``paper_id`` and ``payload``; the whole payload text is searched.
    """
    found = index.groupBy("paper_id").agg(F.min(repo_url(F.col("payload"))).alias("_indexed"))
    keyed = papers.withColumn("paper_id", paper_short_id(F.col(entry_id)))
    url = first_non_empty(F.col("_indexed"), repo_url(F.col(comment)), repo_url(F.col(summary)))
    return (
        keyed.join(found, "paper_id", "left").withColumn("github_url", url).drop("_indexed", "paper_id")
    )


def raw_text(records: DataFrame, texts: DataFrame, url: str) -> DataFrame:
    """Add ``raw_text`` by URL; both sides use the same canonical form.

    ``texts`` is already the latest text per canonical URL (``Store.read_raw_text``).
    """
    keyed = records.withColumn("_key", canonical_url(F.col(url)))
    return keyed.join(texts.select(F.col("url").alias("_key"), "raw_text"), "_key", "left").drop("_key")


def fill_nulls(old: Column, new: Column) -> Column:
    """Keep a stored value; take the update only where nothing is stored."""
    return F.coalesce(old, new)
