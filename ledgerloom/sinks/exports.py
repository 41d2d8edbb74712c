"""JSON and CSV exports. Every export replaces its folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.operators.report import by_confidence, flat_columns, or_empty, summary
from ledgerloom.sinks.store import Store

JSON_NAMES = {
    "startups": "STARTUP",
    "products": "PRODUCT",
    "papers": "RESEARCH_PAPER",
    "jobs": "JOB",
    "news": "NEWS",
}
TABS = {
    "Startups": "STARTUP",
    "Products": "PRODUCT",
    "Research Papers": "RESEARCH_PAPER",
    "Jobs": "JOB",
    "News": "NEWS",
}
MAPPING_TAB = "Entity Mapping Log"


def _json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_json(store: Store, root: str) -> None:
    """Five record sets, the mappings by descending confidence, and the summary."""
    records = {name: store.current(kind) for name, kind in JSON_NAMES.items()}
    for name, df in records.items():
        _json(df.drop("batch_id"), f"{root}/{name}")
    mappings = store.mappings()
    shown = by_confidence(mappings, "url").select(
        F.col("raw_name").alias("raw"), F.col("canonical_name").alias("canonical"), "confidence"
    )
    _json(shown, f"{root}/entity_mappings")
    _json(summary(*records.values(), mappings), f"{root}/summary")


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def export_tabs(store: Store, root: str) -> None:
    """Six flat tables with fixed headers; an empty table keeps its header."""
    for tab, kind in TABS.items():
        _csv(store.current(kind).select(*flat_columns(kind)), f"{root}/{tab}")
    mappings = store.mappings().select(*[or_empty(F.col(c)).alias(c) for c in fv.MAPPING_HEADER])
    _csv(mappings, f"{root}/{MAPPING_TAB}")
