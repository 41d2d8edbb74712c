"""Text expressions: stripping, ordered labels, relevance, names, truncation, prompts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.binding import let


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(strip(text), F.lit("")) == ""


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_non_empty(*texts: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[empty_to_null(t) for t in texts])


def matches(text: Column, pattern: str) -> Column:
    """Unicode-aware, case-insensitive regex search; null text never matches."""
    return F.coalesce(text, F.lit("")).rlike(f"(?iU){pattern}")


def _folded(text: Column) -> Column:
    """Lower case, with the two letters that equal ``s`` and ``i`` when case is ignored but have no such lower case."""
    return let(
        F.lower(F.coalesce(text, F.lit(""))),
        lambda low: F.when(low.contains("ſ") | low.contains("ı"), F.translate(low, "ſı", "si")).otherwise(low),
    )


def _plain_words(pattern: str) -> list[str] | None:
    """Texts of which every match of a pattern contains one: a pattern of words, boundaries and top-level choices."""
    bare = pattern.replace(r"\b", "").replace(r"\-", "-")
    if bare.startswith("(") and bare.endswith(")"):
        bare = bare[1:-1].removeprefix("?:")
    words = [w.lower() for w in bare.split("|")]
    return words if all(w and all(c.isalnum() or c in " -" for c in w) for w in words) else None


def _found(folded: Column, pattern: str) -> Column:
    """Search for one pattern. A plain word is looked for first, which costs far less than the regex and mostly fails."""
    words = _plain_words(pattern)
    regex = folded.rlike(f"(?iU){pattern}")
    if words is None:
        return regex
    contained = reduce(Column.__or__, [folded.contains(w) for w in words])
    return contained & regex if r"\b" in pattern else contained


def label_by_patterns(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The label of the first pattern found in the text, else null."""

    def label(folded: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for pattern, name in reversed(rules):
            chosen = F.when(_found(folded, pattern), F.lit(name)).otherwise(chosen)
        return chosen

    return let(_folded(text), label)


def label_by_keywords(text: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """The label of the first rule with a keyword contained in the lower-cased text, else null."""

    def label(lowered: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for keywords, name in reversed(rules):
            found = reduce(Column.__or__, [lowered.contains(k) for k in keywords])
            chosen = F.when(found, F.lit(name)).otherwise(chosen)
        return chosen

    return let(F.lower(F.coalesce(text, F.lit(""))), label)


def pricing_label(text: Column) -> Column:
    return label_by_patterns(text, fv.PRICING_PATTERNS)


def role_family(title: Column) -> Column:
    return label_by_keywords(title, fv.ROLE_FAMILIES)


def remote_flag(location: Column, explicit: Column | None = None) -> Column:
    """The explicit flag if there is one, else a word search; an empty location stays unknown."""
    found = F.when(F.coalesce(location, F.lit("")) != "", matches(location, fv.REMOTE_PATTERN))
    return found if explicit is None else F.coalesce(explicit, found)


def mentions(text: Column, patterns: Sequence[str]) -> Column:
    """True when the text contains one of the patterns, ignoring case."""
    return let(_folded(text), lambda folded: reduce(Column.__or__, [_found(folded, p) for p in patterns]))


def is_relevant(title: Column, summary: Column, patterns: Sequence[str] = fv.TOPIC_PATTERNS) -> Column:
    """True when title or summary mentions one of the topic patterns."""
    return mentions(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit(""))), patterns)


def normalize_name(raw: Column) -> Column:
    """Lower-case a name and drop domain endings, legal suffixes and punctuation."""
    text = F.lower(F.coalesce(raw, F.lit("")))
    text = F.regexp_replace(text, f"(?iU){fv.DOMAIN_SUFFIX}", "")
    text = F.regexp_replace(text, f"(?iU){fv.LEGAL_SUFFIX}", "")
    text = F.regexp_replace(text, fv.NAME_PUNCTUATION, " ")
    text = F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " ")
    return F.btrim(text)


def chunk_text(text: Column, budget: int = fv.CHAR_BUDGET) -> Column:
    """Cut a text to the budget at the last paragraph end, else sentence end, else hard.

    A boundary counts only if it lies past half of the budget.
    """
    half = budget * 0.5

    def cut(window: Column) -> Column:
        paragraph = F.regexp_extract(window, r"(?s)^(.*)\n\n", 1)
        sentence = F.regexp_extract(window, r"(?sU)^(.*[.!?][\s\x1c-\x1f])", 1)
        return (
            F.when(F.length(paragraph) > half, paragraph)
            .when(F.length(sentence) > half, sentence)
            .otherwise(window)
        )

    def chunk(whole: Column) -> Column:
        shortened = strip(let(F.substring(whole, 1, budget), cut))
        return F.when(F.length(whole) <= budget, whole).otherwise(shortened)

    return let(strip(F.coalesce(text, F.lit(""))), chunk)


def build_prompt(text: Column, schema_description: str, budget: int = fv.CHAR_BUDGET) -> Column:
    head = fv.PROMPT_HEAD + schema_description + fv.PROMPT_TEXT_MARK
    return F.concat(F.lit(head), chunk_text(text, budget))


def truncate_cell(text: Column, limit: int = fv.CELL_LIMIT, suffix: str = fv.CELL_SUFFIX) -> Column:
    """Shorten a long cell and mark the cut; null becomes empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(
        F.length(whole) > limit, F.concat(F.substring(whole, 1, limit), F.lit(suffix))
    ).otherwise(whole)


def source_label(company: Column, platform: Column) -> Column:
    """``Company (Platform)``."""
    return F.concat(company, F.lit(" ("), F.initcap(platform), F.lit(")"))
