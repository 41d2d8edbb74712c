"""Name resolution against a seed table: exact alias or canonical first, then bounded fuzzy matching.

Names are made distinct before any matching, so a name shared by a third of all records is matched
once. Fuzzy candidates come from an equi-join on name segments, never from a cross join: if two
names differ by at most ``k`` insertions and deletions, and one of them is cut into ``k + 1``
segments, some segment is untouched in the other, at an offset that the edits before it explain
(Li, Deng, Wang, Feng: PASS-JOIN, VLDB 2012).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.similarity import (
    differing_bits,
    edit_budget,
    lcs_length,
    length_ratio_ok,
    letter_mask,
    pair_mask,
    passes_cutoff,
)
from ledgerloom.functions.text import normalize_name, strip
from ledgerloom.operators.skew import HOT_ROWS, lookup
from ledgerloom.session import written
from ledgerloom.sources.seeds import labels


def alias_dimension(seeds: DataFrame) -> DataFrame:
    """``norm, canonical, is_canonical``: every normalised spelling, the last writer winning."""
    spellings = seeds.select(
        "canonical",
        "seq",
        F.posexplode(F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias(
            "pos", "name"
        ),
    )
    return (
        spellings.withColumn("norm", normalize_name(F.col("name")))
        .groupBy("norm")
        .agg(
            F.max_by("canonical", F.struct("seq", "pos")).alias("canonical"),
            F.max(F.col("pos") == 0).alias("is_canonical"),
        )
    )


def canonical_dimension(seeds: DataFrame) -> DataFrame:
    """``cand, cand_canonical, cand_order``: normalised canonical names in seed order."""
    return (
        seeds.withColumn("cand", normalize_name(F.col("canonical")))
        .groupBy("cand")
        .agg(F.max_by("canonical", "seq").alias("cand_canonical"), F.min("seq").alias("cand_order"))
    )


def _segments(length: Column, cutoff: int) -> Column:
    """Number of segments for a candidate of this length: its largest possible edit budget plus one."""
    return F.floor(F.lit(2 * (100 - cutoff)) * length / F.lit(cutoff)).cast("int") + 1


def _segment_start(length: Column, count: Column, number: Column) -> Column:
    """Zero-based start of segment ``number`` (1 to ``count``) when ``length`` is cut evenly."""
    return F.floor((number - 1) * length / count).cast("int")


def candidate_segments(candidates: DataFrame, cutoff: int) -> DataFrame:
    """Every candidate once per segment, keyed by its length, segment number and segment text."""
    length = F.col("cand_len")
    start = _segment_start(length, F.col("parts"), F.col("seg_no"))
    stop = _segment_start(length, F.col("parts"), F.col("seg_no") + 1)
    return (
        candidates.withColumn("cand_len", F.length("cand"))
        .withColumn("cand_letters", letter_mask(F.col("cand")))
        .withColumn("cand_pairs", pair_mask(F.col("cand")))
        .where("cand_len > 0")
        .withColumn("parts", _segments(length, cutoff))
        .withColumn("seg_no", F.explode(F.sequence(F.lit(1), F.col("parts"))))
        .withColumn("seg", F.substring(F.col("cand"), start + 1, stop - start))
        .drop("parts")
    )


def candidate_lengths(candidates: DataFrame) -> DataFrame:
    """``cand_len``: the distinct lengths of the candidates."""
    return candidates.select(F.length("cand").alias("cand_len")).where("cand_len > 0").distinct()


def name_probes(names: DataFrame, norm: str, cutoff: int, lengths: DataFrame) -> DataFrame:
    """Every segment text that an acceptable candidate of a name could share with it.

    Names meet the tiny table of candidate ``lengths`` before their segments are laid out, so a name
    beyond the reach of every candidate has no probes.

    With segment ``i`` as the first one the edits spare, exactly ``i - 1`` edits lie before it. So
    its shift has the parity and range of ``i - 1`` single insertions and deletions, and the rest
    of the budget must cover the remaining length difference.
    """
    size = F.col("norm_len")
    low = F.ceil(size * F.lit(cutoff) / F.lit(200 - cutoff)).cast("int")
    high = F.floor(size * F.lit(200 - cutoff) / F.lit(cutoff)).cast("int")
    start = _segment_start(F.col("cand_len"), F.col("parts"), F.col("seg_no"))
    stop = _segment_start(F.col("cand_len"), F.col("parts"), F.col("seg_no") + 1)
    budget = edit_budget(size + F.col("cand_len"), cutoff)
    before = F.col("seg_no") - 1
    position = start + F.col("shift")
    return (
        names.withColumn("norm_len", F.length(norm))
        .withColumn("letters", letter_mask(F.col(norm)))
        .withColumn("pairs", pair_mask(F.col(norm)))
        .where("norm_len > 0")
        .withColumn("cand_len", F.explode(F.sequence(low, high)))
        .join(lengths, "cand_len", "left_semi")
        .withColumn("parts", _segments(F.col("cand_len"), cutoff))
        .withColumn("budget", budget)
        .withColumn("seg_no", F.explode(F.sequence(F.lit(1), F.least(F.col("parts"), F.col("budget") + 1))))
        .withColumn("shift", F.explode(F.sequence(-before, before, F.when(before == 0, F.lit(1)).otherwise(F.lit(2)))))
        .where(F.abs(size - F.col("cand_len") - F.col("shift")) <= F.col("budget") - before)
        .where((position >= 0) & (position + (stop - start) <= size))
        .withColumn("seg", F.substring(F.col(norm), position + 1, stop - start))
        .drop("norm_len", "parts", "shift")
    )


def best_fuzzy(
    names: DataFrame,
    candidates: DataFrame,
    norm: str = "norm",
    cutoff: int = fv.FUZZY_CUTOFF,
    max_length_ratio: float = fv.FUZZY_MAX_LENGTH_RATIO,
) -> DataFrame:
    """Per distinct name the candidate of highest similarity at or above the cut-off.

    Equal scores go to the candidate that comes first in the seed. Columns: the name,
    ``fuzzy_canonical`` and ``fuzzy_confidence``.
    """
    if not 80 <= cutoff <= 100:
        raise ValueError("the cut-off must lie between 80 and 100")
    total = F.length(norm) + F.length("cand")
    probes = name_probes(names.select(norm), norm, cutoff, candidate_lengths(candidates))
    # A segment that many names and candidates share is one key of this join. The sides meet in a plain
    # shuffle join with nothing grouped above it, which AQE splits by size (forced in ``session.SETTINGS``).
    pairs = probes.join(candidate_segments(candidates, cutoff), ["cand_len", "seg_no", "seg"])
    # Short segments are shared by many names; the masks drop nearly all of those pairs at the cost
    # of a few machine instructions each. Plain edit distance never exceeds insertions plus
    # deletions, so its bound loses no match. One CASE keeps the tests in this order, cheap ones
    # first; separate filters would be merged into the join in an order of the optimizer's choice.
    budget = F.col("budget")
    cheap = (
        (differing_bits(F.col("pairs"), F.col("cand_pairs")) <= budget * 3)
        & (differing_bits(F.col("letters"), F.col("cand_letters")) <= budget)
        & length_ratio_ok(F.col(norm), F.col("cand"), max_length_ratio)
    )
    near = F.call_function("levenshtein", F.col(norm), F.col("cand"), budget) >= 0
    survivors = pairs.where(F.when(cheap, near)).select(norm, "cand", "cand_canonical", "cand_order")
    # The subsequence length is interpreted. As a filter it would become part of the join and take
    # that out of compiled code; a pair that fails has no score and no place in the order instead.
    lcs = lcs_length(F.col(norm), F.col("cand"))
    score = F.when(passes_cutoff(F.col("lcs"), total, cutoff), F.lit(2.0) * F.col("lcs") / total)
    scored = survivors.withColumn("lcs", lcs).withColumn("score", score)
    order = F.when(F.col("score").isNotNull(), F.struct(-F.col("score"), "cand_order"))
    return (
        scored.groupBy(norm)
        .agg(F.min_by(F.struct("cand_canonical", "score"), order).alias("best"))
        .where(F.col("best").isNotNull())
        .select(
            norm,
            F.col("best.cand_canonical").alias("fuzzy_canonical"),
            F.bround("best.score", 3).alias("fuzzy_confidence"),
        )
    )


def resolve_distinct(
    names: DataFrame,
    seeds: DataFrame,
    raw: str = "raw_name",
    cutoff: int = fv.FUZZY_CUTOFF,
    min_length: int = fv.FUZZY_MIN_LENGTH,
    max_length_ratio: float = fv.FUZZY_MAX_LENGTH_RATIO,
) -> DataFrame:
    """Resolve a table whose ``raw`` column is distinct; adds ``canonical_name, confidence, method``."""
    blank = F.coalesce(strip(F.col(raw)), F.lit("")) == ""
    keyed = names.withColumn("norm", normalize_name(F.col(raw)))
    # A blank name is never looked up: its key is null.
    keyed = keyed.withColumn("norm", F.when(~blank, F.col("norm")))
    # Written, because two steps use it: a filter on the normal form would otherwise be pushed below
    # the distinct and normalise every record's name again.
    exact = written(keyed.join(alias_dimension(seeds), "norm", "left"), "names")
    open_names = (
        exact.where(F.col("canonical").isNull() & (F.length("norm") >= min_length)).select("norm").distinct()
    )
    fuzzy = best_fuzzy(open_names, canonical_dimension(seeds), "norm", cutoff, max_length_ratio)
    joined = exact.join(fuzzy, "norm", "left")
    return joined.select(
        *names.columns,
        F.coalesce("canonical", "fuzzy_canonical", raw).alias("canonical_name"),
        F.when(F.col("canonical").isNotNull(), F.lit(1.0))
        .otherwise(F.coalesce("fuzzy_confidence", F.lit(0.0)))
        .alias("confidence"),
        F.when(F.col("is_canonical"), F.lit("exact_canonical"))
        .when(F.col("canonical").isNotNull(), F.lit("exact_alias"))
        .when(F.col("fuzzy_canonical").isNotNull(), F.lit("fuzzy"))
        .otherwise(F.lit("no_match"))
        .alias("method"),
    )


def name_union(startups: DataFrame, products: DataFrame) -> DataFrame:
    """Names of both record types, one row per record, nameless records left out."""
    parts = [
        startups.select(F.col("source.url").alias("url"), F.col("content.entityName").alias("raw_name")),
        products.select(F.col("source.url").alias("url"), F.col("content.startupName").alias("raw_name")),
    ]
    return parts[0].unionByName(parts[1]).where(F.coalesce("raw_name", F.lit("")) != "")


def distinct_names(names: DataFrame, raw: str = "raw_name") -> DataFrame:
    """Each name once, with the number of ``records`` that carry it; combined before the shuffle."""
    return names.groupBy(raw).agg(F.count(F.lit(1)).alias("records"))


def mapping_log(
    names: DataFrame,
    seeds: DataFrame,
    spread: str,
    raw: str = "raw_name",
    min_hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One mapping per record, matched or not. Names are resolved once and joined back, hot names salted."""
    counts = written(distinct_names(names, raw), "name-counts")
    resolved = resolve_distinct(counts, seeds, raw)
    return lookup(names, resolved, counts, raw, "records", F.col(spread), min_hot_rows)


def method_counts(resolved: DataFrame, records: str = "records") -> DataFrame:
    """Records per method over resolved distinct names; all four methods appear, with 0 if unused."""
    methods = labels(resolved.sparkSession, "method", fv.METHODS)
    counts = resolved.groupBy("method").agg(F.sum(records).alias("records"))
    return methods.join(counts, "method", "left").select("method", F.coalesce("records", F.lit(0)).alias("records"))
