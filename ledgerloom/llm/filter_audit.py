"""Filter interaction audit: what each filter removes in every order, and its Shapley value by the Hart-Mas-Colell potential.

The removal game of a part gives every coalition of filters the number of rows that at least one of them removes. Its potential
P(S) = (v(S) + sum of P(S without i)) / |S| is worked out coalition by coalition; the Shapley value of a filter is P(all) minus
P(all without it), and a step of an order is the difference of two coalitions. Everything is DataFrame functions: texts are read
once into a bit mask of failed filters, masks are counted per part before the shuffle, and 2^n counts a part are all that is left.

Null texts count as empty, a null part is the empty string. A row without an id is not compared with others (it is never a copy,
and nothing is a copy of it); rows that repeat an id and a text are no copies of each other. An empty table has no parts and
gives no rows. Labels of an id that is labelled several times count if any of them is 1. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texts import SPACE, UPPER
from ledgerloom.session import written

FILTERS = ("A", "B", "C", "D", "E")
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_UPPER = 2  # percent of the characters
SYMBOLS = "#$%&*|"
MOST_FILTERS = 8  # there are n! orders


def text_failures(docs: DataFrame, *carry: str) -> DataFrame:
    """What the text itself decides: doc_id, the carried columns, A to D, and a digest of the text."""
    plain = docs.select(F.col("doc_id"), *carry, F.coalesce("text", F.lit("")).alias("_text"))
    words = F.array_remove(F.split(F.translate("_text", SPACE[1:], " " * (len(SPACE) - 1)), " "), "")
    counted = plain.withColumn("_words", words).select(
        "doc_id", *carry, "_text", F.size("_words").alias("_n"), F.size(F.array_distinct("_words")).alias("_distinct")
    )
    upper = F.octet_length("_text") - F.octet_length(F.translate("_text", UPPER, ""))
    return counted.select(
        "doc_id",
        *carry,
        (F.col("_n") < LEAST_WORDS).alias("A"),
        (100 * F.col("_distinct").cast("long") < LEAST_DISTINCT * F.col("_n").cast("long")).alias("B"),
        (100 * upper.cast("long") > MOST_UPPER * F.char_length("_text").cast("long")).alias("C"),
        F.col("_text").rlike("[" + SYMBOLS + "]").alias("D"),
        F.unhex(F.sha2("_text", 256)).alias("digest"),
    )


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """Per document: doc_id, ``part``, and which filters it fails (booleans A to E; E: a smaller id has the same text).

    The least id of each text is combined before the shuffle. Documents meet it on text and id together, so a text that a
    third of all documents share is spread over their ids.
    """
    named = docs.select("doc_id", "text", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    flags = written(text_failures(named, "part"), "filter-flags")
    firsts = flags.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    found = flags.join(firsts.withColumn("_first", F.lit(True)), ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return found.select("doc_id", "part", "A", "B", "C", "D", copy.alias("E"))


def with_losses(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``: whether the document is labelled so."""
    marked = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    joined = rows.join(marked, "doc_id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c) == 1, F.lit(False)) for c in ("good", "toxic")})


def _game(counts: Column, coalitions: int) -> Column:
    """v(S) for every coalition S from the number of rows per mask of failed filters."""
    masks = F.sequence(F.lit(0), F.lit(coalitions - 1))

    def removed(coalition: Column) -> Column:
        hit = lambda mask: mask.bitwiseAND(coalition) != 0
        return F.aggregate(F.filter(masks, hit), F.lit(0).cast("long"), lambda total, mask: total + F.get(counts, mask))

    return F.transform(masks, removed)


def _potential(game: Column, coalitions: int) -> Column:
    """|S|! P(S) for every coalition in order of its number; the coalitions without one member come before it.

    |S|! P(S) = (|S| - 1)! v(S) + sum over members i of |S without i|! P(S without i), which stays within whole numbers.
    """
    singles = F.array(*[F.lit(1 << b) for b in range(coalitions.bit_length() - 1)])

    def extend(known: Column, coalition: Column) -> Column:
        members = F.filter(singles, lambda one: one.bitwiseAND(coalition) != 0)
        smaller = F.aggregate(members, F.lit(0).cast("long"), lambda total, one: total + F.get(known, coalition - one))
        ways = F.factorial(F.bit_count(coalition) - 1)
        return F.array_append(known, ways * F.get(game, coalition) + smaller)

    return F.aggregate(F.sequence(F.lit(1), F.lit(coalitions - 1)), F.array(F.lit(0).cast("long")), extend)


def _plays(filters: Sequence[str]) -> Column:
    """Every step of every order as a constant array: filter_order, step, its filter's bit, and the coalition before it."""
    plays = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            plays.append({"filter_order": "".join(filters[i] for i in order), "step": step, "name": filters[f], "bit": 1 << f, "before": before})
            before |= 1 << f
    return F.from_json(F.lit(json.dumps(plays)), "array<struct<filter_order:string,step:int,name:string,bit:int,before:int>>")


def audit(rows: DataFrame, filters: Sequence[str], part: str, losses: Mapping[str, str]) -> DataFrame:
    """Per part, order of the filters and step: filter, kept, removed, redundant, unique_fails, one count per loss, shapley.

    ``rows`` has a boolean per filter (true: fails it), and a boolean per loss; ``losses`` maps a loss's column to the name of its
    count. ``shapley`` is the Shapley value times n!, that is the filter's removals summed over all orders. At most 8 filters.
    """
    if not 0 < len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters can be audited, not {len(filters)}")
    coalitions, everyone = 1 << len(filters), (1 << len(filters)) - 1
    mask = sum((F.when(F.col(f), F.lit(1 << b)).otherwise(F.lit(0)) for b, f in enumerate(filters)), F.lit(0))
    games = {"n": F.lit(True), **{name: F.col(column) for column, name in losses.items()}}
    sums = [F.sum(hit.cast("long")).alias(f"_{g}") for g, hit in games.items()]
    counted = rows.groupBy(F.col(part).alias("_part"), mask.alias("_mask")).agg(*sums)
    entry = F.struct("_mask", F.struct(*[f"_{g}" for g in games]).alias("c"))
    wide = counted.groupBy("_part").agg(F.map_from_entries(F.collect_list(entry)).alias("_counts"))  # at most 2^n entries
    masks = F.sequence(F.lit(0), F.lit(everyone))
    value = lambda g: F.transform(masks, lambda m: F.coalesce(F.try_element_at("_counts", m)[f"_{g}"], F.lit(0).cast("long")))
    wide = wide.select("_part", *[value(g).alias(f"_{g}") for g in games])
    total = F.aggregate("_n", F.lit(0).cast("long"), lambda t, x: t + x)
    wide = wide.select("_part", total.alias("_total"), *[_game(F.col(f"_{g}"), coalitions).alias(f"_{g}") for g in games])
    wide = wide.withColumn("_potential", _potential(F.col("_n"), coalitions))
    steps = wide.select("*", F.explode(_plays(filters)).alias("p")).select("*", "p.*").drop("p")
    after = F.col("before") + F.col("bit")
    gain = lambda g: F.get(F.col(f"_{g}"), after) - F.get(F.col(f"_{g}"), F.col("before"))
    without = F.lit(everyone) - F.col("bit")
    return steps.select(
        F.col("_part").alias("part"),
        "filter_order",
        "step",
        F.col("name").alias("filter"),
        (F.col("_total") - F.get("_n", after)).alias("kept"),
        gain("n").alias("removed"),
        (F.get("_n", "bit") - gain("n")).alias("redundant"),
        (F.get("_n", F.lit(everyone)) - F.get("_n", without)).alias("unique_fails"),
        *[gain(name).alias(name) for name in losses.values()],
        (F.get("_potential", F.lit(everyone)) - len(filters) * F.get("_potential", without)).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The five filters over documents, with what they cost of good and toxic ones; see ``failures`` and ``audit``."""
    rows = with_losses(failures(docs, part), labels)
    return audit(rows, FILTERS, "part", {"good": "good_lost", "toxic": "toxic_lost"})
