"""One decision per key: saved, or the reason why not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import is_fresh
from ledgerloom.functions.text import is_blank

SAVED = "saved"
ALREADY_SEEN = "already_seen"
IRRELEVANT = "irrelevant"
STALE = "stale"
DATELESS = "dateless"
UNREADABLE_DATE = "unreadable_date"
INVALID = "invalid"

# Rejections whose keys are remembered, so that later runs do not check them again.
MARKED_REJECTIONS = (IRRELEVANT, STALE, DATELESS)


def freshness_reason(dt: Column, now: Column, dateless: str = "keep", raw: Column | None = None) -> Column:
    """``stale``, ``dateless`` (only when such rows are dropped) or null for an accepted date.

    With the ``raw`` text of the date, a text in a form that is not known is ``unreadable_date`` where dateless rows are dropped. It
    is not remembered, so the row comes again when its form is known.
    """
    if dateless not in ("keep", "drop"):
        raise ValueError("dateless must be 'keep' or 'drop'")
    missing = F.lit(DATELESS) if dateless == "drop" else F.lit(None).cast("string")
    if raw is not None and dateless == "drop":
        missing = F.when(is_blank(raw), missing).otherwise(F.lit(UNREADABLE_DATE))
    return F.when(dt.isNull(), missing).when(~is_fresh(dt, now), F.lit(STALE))


def first_reason(*reasons: Column) -> Column:
    return F.coalesce(*reasons)


def firsts(rows: DataFrame, seen: DataFrame, key: str, seq: Sequence[str]) -> DataFrame:
    """One row per key, the first in landing order, with the number of ``copies`` and whether the key is ``_seen``.

    The copies are combined before the shuffle. Call it on the narrow landed columns; what is worked
    out of them is then worked out once per key.
    """
    rest = [c for c in rows.columns if c != key]
    order = F.struct(*[F.col(c) for c in seq])
    one = rows.groupBy(key).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_first"),
        F.count(F.lit(1)).alias("copies"),
    ).select(key, "_first.*", "copies")
    known = seen.select(F.col(key).alias("_seen_key")).distinct()
    joined = one.join(known, F.col(key) == F.col("_seen_key"), "left")
    return joined.withColumn("_seen", F.col("_seen_key").isNotNull()).drop("_seen_key")


def settle(rows: DataFrame, reason: Column) -> DataFrame:
    """Add ``outcome``: a key that was seen before is settled whatever its content; otherwise the
    ``reason`` decides, and a null reason means saved."""
    outcome = F.when(F.col("_seen"), F.lit(ALREADY_SEEN)).otherwise(F.coalesce(reason, F.lit(SAVED)))
    return rows.withColumn("outcome", outcome).drop("_seen")


def decide(
    rows: DataFrame,
    seen: DataFrame,
    key: str,
    seq: Sequence[str],
    reason: Column,
) -> DataFrame:
    """One row per key, the first in landing order, with ``outcome`` and the number of ``copies``."""
    return settle(firsts(rows, seen, key, seq), reason)


def accounting(decisions: DataFrame) -> DataFrame:
    """Keys and input rows per outcome; ``copies`` beyond the first of a key count as duplicates."""
    return decisions.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("copies").alias("input_rows"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
    )


def keys_to_mark(decisions: DataFrame, key: str, mark_rejected: bool) -> DataFrame:
    """Keys to remember after a run: saved ones, and judged rejections where the type marks them."""
    outcomes = [SAVED, *MARKED_REJECTIONS] if mark_rejected else [SAVED]
    return decisions.where(F.col("outcome").isin(outcomes)).select(key)
