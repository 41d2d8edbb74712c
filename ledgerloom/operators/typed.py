"""Type checks of JSON payloads before any typed read.

A payload is parsed to a VARIANT once. A table of rules, a path and a kind each, is compiled into checks on the value's own type, so
a wrong type is a reason with its path and never a silent null. Values are accepted in the lax way of the usual record
validators: a whole number may come as ``3.0``, ``"3"`` or a boolean, a boolean as 0, 1 or one of its words; text must be text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.binding import let
from ledgerloom.functions.text import strip
from ledgerloom.functions.urls import is_http_url
from ledgerloom.operators.validate import CONTENT

TEXT, INTEGER, BOOLEAN, URL, TIME, TEXTS, OBJECT, PRICING = "text", "integer", "boolean", "url", "time", "texts", "object", "pricing"

# The words of a boolean, in any case, as record validators accept them.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")
_INTEGER = r"^[+-]?[0-9]+(\.0+)?$"
_ISO_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"

REASONS = {
    TEXT: "not a text",
    INTEGER: "not a whole number",
    BOOLEAN: "not true or false",
    URL: "not a URL",
    TIME: "not an ISO time",
    TEXTS: "not a list of texts",
    OBJECT: "not an object",
    PRICING: "not an allowed value",
}
MISSING = "missing"
BROKEN = "broken JSON"
UNKNOWN_TYPE = "unknown record type"
_REJECTS = "array<struct<path:string,reason:string>>"


@dataclass(frozen=True)
class Rule:
    path: str
    kind: str
    required: bool = False


_ENVELOPE = (
    Rule("$.schemaVersion", TEXT), Rule("$.recordType", TEXT), Rule("$.source", OBJECT, True), Rule("$.source.name", TEXT, True),
    Rule("$.source.url", URL, True), Rule("$.collectedAt", TIME), Rule("$.content", OBJECT, True),
)
# A field with a default may be absent but not null; one that may be null has ``required`` false and no default.
DEFAULTED = ("$.schemaVersion", "$.recordType", "$.collectedAt", "$.content.data", "$.content.authors")
RULES: dict[str, tuple[Rule, ...]] = {
    "STARTUP": (Rule("$.content.entityName", TEXT, True), Rule("$.content.data", OBJECT), Rule("$.content.data.employeeCount", INTEGER)),
    "PRODUCT": (Rule("$.content.startupName", TEXT, True), Rule("$.content.pricingModel", PRICING)),
    "RESEARCH_PAPER": (
        Rule("$.content.title", TEXT, True), Rule("$.content.authors", TEXTS), Rule("$.content.paper_url", URL, True),
        Rule("$.content.github_url", URL), Rule("$.content.github_stars", INTEGER), Rule("$.content.published_date", TIME),
    ),
    "JOB": (
        Rule("$.content.company", TEXT, True), Rule("$.content.date", TIME), Rule("$.content.is_remote", BOOLEAN), Rule("$.content.role_family", TEXT),
    ),
    "NEWS": (Rule("$.content.title", TEXT, True), Rule("$.content.publishedDate", TIME), Rule("$.content.fullText", TEXT)),
}


def _at(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def _whole(value: Column, path: str, type_name: Column) -> Column:
    """The number, or null if it is none that fits a long."""
    text = strip(_at(value, path, "string"))
    number = F.when(text.rlike(_INTEGER), F.regexp_replace(text, r"\..*$", "").try_cast("bigint"))
    fraction = _at(value, path, "decimal(38,9)")
    return (
        F.when(type_name == "STRING", number)
        .when(type_name == "BOOLEAN", _at(value, path, "boolean").cast("bigint"))
        .when(fraction == F.floor(fraction), fraction.try_cast("bigint"))
    )


def _boolean(value: Column, path: str, type_name: Column) -> Column:
    word = F.lower(_at(value, path, "string"))
    number = _at(value, path, "double")
    return (
        F.when(type_name == "BOOLEAN", _at(value, path, "boolean"))
        .when(type_name == "STRING", F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False))
        .when(number.isin(0.0, 1.0), number == 1.0)
    )


def _texts(value: Column, path: str, type_name: Column) -> Column:
    """The list, if all of its members are texts."""
    items = _at(value, path, "array<string>")
    return F.when(type_name.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(items, lambda item: item.isNull()), items)


def _time(value: Column, path: str, type_name: Column) -> Column:
    text = F.when(type_name == "STRING", _at(value, path, "string"))
    return F.when(text.rlike(_ISO_TIME), text.try_cast("timestamp"))


def _text(value: Column, path: str, type_name: Column) -> Column:
    return F.when(type_name == "STRING", _at(value, path, "string"))


def _url(value: Column, path: str, type_name: Column) -> Column:
    text = _text(value, path, type_name)
    return F.when(is_http_url(text), text)


def _pricing(value: Column, path: str, type_name: Column) -> Column:
    text = _text(value, path, type_name)
    return F.when(text.isin(*fv.PRICING_VALUES), text)


def _object(value: Column, path: str, type_name: Column) -> Column:
    return F.when(type_name.startswith("OBJECT"), F.lit(True))


# Kind -> the value in its type, null where it does not fit.
READERS: dict[str, Callable[[Column, str, Column], Column]] = {
    TEXT: _text, INTEGER: _whole, BOOLEAN: _boolean, URL: _url, TIME: _time, TEXTS: _texts, OBJECT: _object, PRICING: _pricing,
}


def _type_name(value: Column, path: str) -> Column:
    """The type of the value at a path; ``VOID`` for a JSON null, null where there is no value."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def _reason(value: Column, rule: Rule) -> Column:
    path, parent = F.lit(rule.path), rule.path.rpartition(".")[0]
    inside = F.lit(True) if parent == "$" else F.coalesce(_type_name(value, parent).startswith("OBJECT"), F.lit(False))
    fault = lambda text: F.struct(path.alias("path"), F.lit(text).alias("reason"))
    nullable = not rule.required and rule.path not in DEFAULTED

    def judged(type_name: Column) -> Column:
        absent = F.when(F.lit(rule.required), fault(MISSING))
        null = fault(MISSING if rule.required else REASONS[rule.kind])
        wrong = F.when(READERS[rule.kind](value, rule.path, type_name).isNull(), fault(REASONS[rule.kind]))
        return F.when(type_name.isNull(), absent).when(type_name == "VOID", F.lit(None) if nullable else null).otherwise(wrong)

    return F.when(inside, let(_type_name(value, rule.path), judged))  # below a parent that is no object, the parent is the fault


def _record(value: Column, record_type: str) -> Column:
    read = lambda path, kind: READERS[kind](value, path, _type_name(value, path))
    by_path = {rule.path: rule.kind for rule in RULES[record_type]}
    field = lambda name: read(f"$.content.{name}", by_path[f"$.content.{name}"]).alias(name)
    if record_type == "STARTUP":
        count = read("$.content.data.employeeCount", INTEGER).alias("employeeCount")
        content = F.struct(field("entityName"), F.struct(count).alias("data"))
    else:
        content = F.struct(*[field(path.removeprefix("$.content.")) for path in by_path])
    if record_type == "RESEARCH_PAPER":
        content = content.withField("authors", F.coalesce(field("authors"), F.array().cast("array<string>")))
    return F.struct(
        F.coalesce(read("$.schemaVersion", TEXT), F.lit(fv.SCHEMA_VERSION)).alias("schemaVersion"),
        F.coalesce(read("$.recordType", TEXT), F.lit(record_type)).alias("recordType"),
        F.struct(read("$.source.name", TEXT).alias("name"), read("$.source.url", URL).alias("url")).alias("source"),
        content.cast(CONTENT[record_type]).alias("content"),
        read("$.collectedAt", TIME).alias("collectedAt"),
    )


def judge_payloads(rows: DataFrame, record_type: str, payload: str = "payload") -> DataFrame:
    """Adds ``record`` (null where rejected) and ``rejects`` (path and reason of every fault; empty where valid) to rows of one type.

    One pass, no shuffle; other columns stay. A payload that is null, no JSON or no object is rejected at ``$``. Members that
    no rule names are ignored; an absent ``collectedAt`` is null and left to the caller.
    """
    if record_type not in RULES:
        raise ValueError(f"{UNKNOWN_TYPE}: {record_type}")
    value = F.col("_value")
    whole = F.array(F.struct(F.lit("$").alias("path"), F.lit(BROKEN).alias("reason"))).cast(_REJECTS)
    no_object = F.array(F.struct(F.lit("$").alias("path"), F.lit(REASONS[OBJECT]).alias("reason"))).cast(_REJECTS)
    faults = F.array_compact(F.array(*[_reason(value, rule) for rule in (*_ENVELOPE, *RULES[record_type])])).cast(_REJECTS)
    parsed = rows.withColumn("_value", F.try_parse_json(F.col(payload)))
    rejects = F.when(value.isNull(), whole).when(~F.schema_of_variant(value).startswith("OBJECT"), no_object).otherwise(faults)
    judged = parsed.withColumn("rejects", rejects)
    return judged.withColumn("record", F.when(F.size("rejects") == 0, _record(value, record_type))).drop("_value")


def typed_records(judged: DataFrame) -> DataFrame:
    """The valid records of ``judge_payloads`` as rows of the record's own columns."""
    return judged.where(F.size("rejects") == 0).select("record.*")
