"""Expressions over extraction answers: fence removal, strict JSON objects, enum checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.binding import let
from ledgerloom.functions.text import strip


def strip_fences(raw: Column) -> Column:
    """Remove a Markdown code fence around an answer."""
    return let(
        strip(raw),
        lambda text: F.when(
            text.contains("```"), strip(F.regexp_replace(text, f"(?Umd){fv.FENCE_PATTERN}", ""))
        ).otherwise(text),
    )


def json_object(raw: Column) -> Column:
    """The answer as VARIANT if it is exactly one JSON object, else null.

    The built-in parser ignores text after the first value. No tail survives both wrappings:
    one would have to continue an array, the other an object.
    """

    def single(text: Column) -> Column:
        keyed = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
        listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
        # An element besides the first would be a second answer.
        only = let(
            listed,
            lambda v: F.when(
                F.try_variant_get(v, "$[1]", "variant").isNull(), F.try_variant_get(v, "$[0]", "variant")
            ),
        )
        return F.when(text.startswith("{") & text.endswith("}") & keyed.isNotNull(), only)

    return let(strip_fences(raw), single)


def answer_text(body: Column, path: str) -> Column:
    """The answer inside a provider's response body; null when the shape is unexpected.

    A JSON null in the right place is an empty answer.
    """
    return let(
        F.try_variant_get(F.try_parse_json(body), path, "variant"),
        lambda value: F.when(F.is_variant_null(value), F.lit("")).otherwise(F.try_variant_get(value, "$", "string")),
    )


def variant_string(data: Column, field: str) -> Column:
    """A field's value if it is a JSON string; numbers and other types give null."""
    return let(
        F.try_variant_get(data, f"$.{field}", "variant"),
        lambda value: F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")),
    )


def valid_enum(value: Column, allowed: Sequence[str] = fv.PRICING_VALUES) -> Column:
    """The stripped, upper-cased value if it is allowed, else null."""
    return let(F.upper(strip(value)), lambda upper: F.when(upper.isin(*allowed), upper))
