"""Record envelopes and their schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.urls import is_http_url
from ledgerloom.session import run_folder

CONTENT = {
    "STARTUP": "struct<entityName:string,data:struct<employeeCount:bigint>>",
    "PRODUCT": "struct<startupName:string,pricingModel:string>",
    "RESEARCH_PAPER": (
        "struct<title:string,authors:array<string>,paper_url:string,github_url:string,"
        "github_stars:bigint,published_date:timestamp>"
    ),
    "JOB": "struct<company:string,date:timestamp,is_remote:boolean,role_family:string>",
    "NEWS": "struct<title:string,publishedDate:timestamp,fullText:string>",
}

ENVELOPE = (
    "schemaVersion string, recordType string, source struct<name:string,url:string>, "
    "content {content}, collectedAt timestamp"
)


def record_schema(record_type: str) -> str:
    return ENVELOPE.format(content=CONTENT[record_type])


def envelope(record_type: str, source_name: Column, url: Column, content: Column, at: Column) -> list[Column]:
    """The five envelope columns around a content struct."""
    return [
        F.lit(fv.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(record_type).alias("recordType"),
        F.struct(source_name.alias("name"), url.alias("url")).alias("source"),
        content.cast(CONTENT[record_type]).alias("content"),
        at.alias("collectedAt"),
    ]


def _required(value: Column, name: str) -> Column:
    return F.when(value.isNull(), F.lit(f"{name} is missing"))


def _url(value: Column, name: str) -> Column:
    return F.when(value.isNotNull() & ~is_http_url(value), F.lit(f"{name} is not a URL"))


def checks(record_type: str) -> list[Column]:
    """One reason or null per rule of the record type."""
    content = F.col("content")
    rules = [
        _required(F.col("source.name"), "source.name"),
        _required(F.col("source.url"), "source.url"),
        _url(F.col("source.url"), "source.url"),
    ]
    if record_type == "STARTUP":
        rules.append(_required(content["entityName"], "entityName"))
    elif record_type == "PRODUCT":
        pricing = content["pricingModel"]
        rules.append(_required(content["startupName"], "startupName"))
        rules.append(
            F.when(pricing.isNotNull() & ~pricing.isin(*fv.PRICING_VALUES), F.lit("pricingModel is not allowed"))
        )
    elif record_type == "RESEARCH_PAPER":
        rules.append(_required(content["title"], "title"))
        rules.append(_required(content["paper_url"], "paper_url"))
        rules.append(_url(content["paper_url"], "paper_url"))
        rules.append(_url(content["github_url"], "github_url"))
    elif record_type == "JOB":
        rules.append(_required(content["company"], "company"))
    return rules


def reject_reasons(rules: list[Column]) -> Column:
    """All reasons that apply, in rule order; empty for a valid row."""
    return F.array_compact(F.array(*rules))


def split_valid(df: DataFrame, rules: list[Column], once: bool = True) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with ``reject_reason``. No row is coerced or lost.

    The checked rows are written once, in a folder for each of the two, so neither repeats the other's work. Where ``df`` is
    cheap to read again, such as a table, say ``once=False``: nothing is written.
    """
    checked = df.withColumn("reject_reason", reject_reasons(rules)).withColumn("_valid", F.size("reject_reason") == 0)
    if not once:
        return checked.where("_valid").drop("reject_reason", "_valid"), checked.where("NOT _valid").drop("_valid")
    path = run_folder(df.sparkSession, "checked")
    checked.write.partitionBy("_valid").parquet(path)
    back = df.sparkSession.read.schema(checked.schema).parquet(path)
    return back.where("_valid").drop("reject_reason", "_valid"), back.where("NOT _valid").drop("_valid")


def split_records(df: DataFrame, record_type: str, once: bool = True) -> tuple[DataFrame, DataFrame]:
    return split_valid(df, checks(record_type), once)
