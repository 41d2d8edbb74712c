"""Ordered provider fallback over landed responses, enrichment rows and enum backfill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.answers import answer_text, json_object, valid_enum, variant_string
from ledgerloom.functions.text import build_prompt, is_blank
from ledgerloom.operators.lookups import fill_nulls


def prompts(records: DataFrame, key: str, text: str, schema_description: str, budget: int = fv.CHAR_BUDGET) -> DataFrame:
    """The prompt table that a caller sends out; records with blank text need no prompt."""
    return records.where(~is_blank(F.col(text))).select(
        key, build_prompt(F.col(text), schema_description, budget).alias("prompt")
    )


def latest_responses(
    responses: DataFrame,
    key: str,
    providers: Sequence[str] = fv.PROVIDERS,
    paths: Mapping[str, str] = fv.ANSWER_PATHS,
    seq: str = "seq",
) -> DataFrame:
    """One row per key with a ``{provider}_answer`` and ``{provider}_error`` per provider.

    ``responses`` has the key, ``provider``, ``body``, ``error`` and ``seq``; the latest one per key and
    provider counts. This is one aggregation, combined before the shuffle, whose state is one
    response per provider, however many responses a key has.
    """
    aggregates = []
    for name in providers:
        # A response without ``seq`` comes before all others; equal ones are told apart by their content.
        rank = F.struct(F.col(seq).isNotNull(), F.col(seq), F.col("error").isNull(), "body", "error")
        last = F.max_by(
            F.when(F.col("provider") == name, F.struct("body", "error")),
            F.when(F.col("provider") == name, rank),
        )
        aggregates.append(last.alias(f"_{name}"))
    grouped = responses.where(F.col("provider").isin(*providers)).groupBy(key).agg(*aggregates)
    columns = [F.col(key)]
    for name in providers:
        last = F.col(f"_{name}")
        answer = F.when(last["error"].isNull(), answer_text(last["body"], paths[name]))
        failure = F.when(
            last.isNotNull() & answer.isNull(), F.coalesce(last["error"], F.lit("unexpected response shape"))
        )
        columns += [answer.alias(f"{name}_answer"), failure.alias(f"{name}_error")]
    return grouped.select(*columns)


def provider_fallback(
    records: DataFrame,
    responses: DataFrame,
    key: str,
    providers: Sequence[str] = fv.PROVIDERS,
    paths: Mapping[str, str] = fv.ANSWER_PATHS,
    seq: str = "seq",
) -> DataFrame:
    """Add ``data`` (VARIANT), ``provider_used`` and ``attempts`` to every record.

    Providers are tried in order; the first answer that is one JSON object wins. A missing
    response counts as skipped, an error or an unparseable answer leads to the next provider,
    and total failure keeps the record with null data.
    """
    joined = records.join(latest_responses(responses, key, providers, paths, seq), key, "left")
    for name in providers:
        joined = joined.withColumn(f"_{name}_data", json_object(F.col(f"{name}_answer")))
    messages, chosen, used, winner = [], F.lit(None), F.lit(None).cast("string"), F.lit(None).cast("int")
    for position, name in reversed(list(enumerate(providers, start=1))):
        parsed = F.col(f"_{name}_data")
        chosen = F.when(parsed.isNotNull(), parsed).otherwise(chosen)
        used = F.when(parsed.isNotNull(), F.lit(name)).otherwise(used)
        winner = F.when(parsed.isNotNull(), F.lit(position)).otherwise(winner)
    for name in providers:
        answer, error = F.col(f"{name}_answer"), F.col(f"{name}_error")
        messages.append(
            F.when(F.col(f"_{name}_data").isNotNull(), F.lit(name + fv.ATTEMPT_SUCCESS))
            .when(error.isNotNull(), F.concat(F.lit(f"{name}: failed ("), error, F.lit(")")))
            .when(answer.isNotNull(), F.lit(name + fv.ATTEMPT_UNPARSEABLE))
            .otherwise(F.lit(name + fv.ATTEMPT_SKIPPED))
        )
    log = F.array(*messages)
    attempts = F.when(winner.isNull(), F.array_append(log, F.lit(fv.ATTEMPTS_EXHAUSTED))).otherwise(
        F.slice(log, F.lit(1), winner)
    )
    return joined.select(
        *records.columns, chosen.alias("data"), used.alias("provider_used"), attempts.alias("attempts")
    )


def enrichment_log(
    news: DataFrame, responses: DataFrame, key: str, text: str, at: Column, **options
) -> DataFrame:
    """One row per news record: the extraction, or why there is none. Failures are kept.

    A record without text is logged as skipped and has no ``enrichedAt``.
    """
    has_text = F.coalesce(F.col(text), F.lit("")) != ""
    tried = provider_fallback(news.select(key, has_text.alias("_has_text")), responses, key, **options)
    return tried.select(
        F.col(key).alias("sourceUrl"),
        F.when(F.col("_has_text"), F.col("data")).alias("extraction"),
        F.when(F.col("_has_text"), F.col("provider_used")).alias("providerUsed"),
        F.when(F.col("_has_text"), F.col("attempts")).otherwise(F.array(F.lit(fv.ENRICHMENT_SKIPPED))).alias("attempts"),
        F.when(F.col("_has_text"), at).alias("enrichedAt"),
    )


def enrichment_success(log: DataFrame) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("extraction").isNotNull()).alias("succeeded"))


def enum_backfill(
    records: DataFrame,
    responses: DataFrame,
    key: str,
    stored: str,
    text: str,
    field: str,
    allowed: Sequence[str] = fv.PRICING_VALUES,
    **options,
) -> DataFrame:
    """Fill a null enum from validated answers; adds ``new_value`` and the resulting ``value``.

    Only rows with a null value and a non-blank text are looked at, and only their keys meet the
    responses; an answer outside the allowed values is no answer.
    """
    open_row = F.col(stored).isNull() & ~is_blank(F.col(text))
    wanted = records.where(open_row).select(key).distinct()
    mine = responses.join(wanted, key, "left_semi")
    tried = provider_fallback(wanted, mine, key, **options)
    answers = tried.select(
        F.col(key).alias("_open"),
        valid_enum(variant_string(F.col("data"), field), allowed).alias("_answer"),
        F.col("provider_used").alias("_provider"),
    )
    return (
        records.join(answers, F.col(key) == F.col("_open"), "left")
        .withColumn("provider_used", F.when(open_row, F.col("_provider")))
        .withColumn("new_value", F.when(open_row, F.col("_answer")))
        .withColumn("value", fill_nulls(F.col(stored), F.col("new_value")))
        .drop("_open", "_answer", "_provider")
    )


def backfill_report(filled: DataFrame, stored: str) -> DataFrame:
    """Rows with a null value, and those among them that got a validated one."""
    return filled.agg(
        F.count_if(F.col(stored).isNull()).alias("attempted"),
        F.count_if(F.col(stored).isNull() & F.col("new_value").isNotNull()).alias("backfilled"),
    )
