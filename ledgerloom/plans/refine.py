"""Jobs over stored records: resolve names, backfill pricing, enrich news, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.urls import canonical_url
from ledgerloom.operators.extract import (
    backfill_report,
    enrichment_log,
    enrichment_success,
    enum_backfill,
    prompts,
)
from ledgerloom.operators.dedup import first_per_key
from ledgerloom.operators.lookups import raw_text
from ledgerloom.operators.resolve import distinct_names, mapping_log, method_counts, name_union, resolve_distinct
from ledgerloom.session import written
from ledgerloom.sinks.store import Store


def resolve_names(store: Store, seeds: DataFrame, run_id: int) -> DataFrame:
    """Log a mapping for every named startup and product; returns the four method counts."""
    names = name_union(store.records("STARTUP"), store.records("PRODUCT"))
    store.append_mappings(mapping_log(names, seeds, "url"), run_id)
    return method_counts(resolve_distinct(distinct_names(names), seeds))


def open_products(store: Store) -> DataFrame:
    """Products with their URL key, current pricing and raw text."""
    records = store.current("PRODUCT").select(
        canonical_url(F.col("source.url")).alias("key"), F.col("content.pricingModel").alias("pricing"), "content"
    )
    return raw_text(records, store.raw_text(), "key")


def pricing_prompts(store: Store) -> DataFrame:
    unpriced = open_products(store).where(F.col("pricing").isNull())
    return prompts(unpriced, "key", "raw_text", fv.PRICING_SCHEMA)


def backfill_pricing(store: Store, responses: DataFrame, batch_id: int) -> DataFrame:
    """Log validated pricing for products without one; returns the report.

    Only the filled products are written, as updates; ``store.current`` has all of them with their pricing.
    """
    filled = written(enum_backfill(open_products(store), responses, "key", "pricing", "raw_text", "pricingModel"), "backfill")
    content = F.col("content").withField("pricingModel", F.col("new_value"))
    updates = filled.where(F.col("new_value").isNotNull()).select(F.col("key").alias("url"), content.alias("content"))
    store.append_updates(first_per_key(updates, ["url"], "content"), "PRODUCT", batch_id)
    return backfill_report(filled, "pricing")


def news_prompts(store: Store) -> DataFrame:
    texts = store.records("NEWS").select(F.col("source.url").alias("key"), F.col("content.fullText").alias("text"))
    return prompts(texts, "key", "text", fv.NEWS_SCHEMA)


def enrich_news(store: Store, responses: DataFrame, run_id: int, at: Column) -> DataFrame:
    """Append one enrichment row per news record; returns the success count."""
    news = store.records("NEWS").select(F.col("source.url").alias("key"), F.col("content.fullText").alias("text"))
    store.append_enriched(enrichment_log(news, responses, "key", "text", at), run_id)
    return enrichment_success(store.enriched())
