"""Readable text of a web page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.binding import let
from ledgerloom.functions.text import empty_to_null

# Elements without body text, block ends, and the basic entities.
SKIPPED_ELEMENTS = ("script", "style", "nav", "noscript", "head", "footer")
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)


# One token is a comment, a raw element with its content, a tag, or a word between them; HTML's own white space parts words.
HTML_SPACE = r" \t\n\f\r"
TOKENS = rf"(?is)<!--.*?-->|<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>|</?[a-z!?][^>]*>|[^<{HTML_SPACE}]+|<"
TAG_COST = 2


def _decoded(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def densest_run(gains: Column) -> Column:
    """``start`` and ``length`` of the run of numbers with the greatest sum, 0-based; length 0 if no number is above zero.

    A run starts anew behind a sum of zero or less, and of equal runs the one that ends first counts.
    """
    zero = F.lit(0)
    state = F.struct(
        zero.alias("at"), zero.alias("sum"), zero.alias("from"), zero.alias("best"), zero.alias("start"), zero.alias("length")
    )

    def step(run: Column, gain: Column) -> Column:
        anew = run["sum"] <= 0
        first = F.when(anew, run["at"]).otherwise(run["from"])
        total = F.when(anew, gain).otherwise(run["sum"] + gain)
        better = total > run["best"]
        return F.struct(
            (run["at"] + 1).alias("at"),
            total.alias("sum"),
            first.alias("from"),
            F.when(better, total).otherwise(run["best"]).alias("best"),
            F.when(better, first).otherwise(run["start"]).alias("start"),
            F.when(better, run["at"] + 1 - first).otherwise(run["length"]).alias("length"),
        )

    return F.aggregate(gains, state, step, lambda run: F.struct(run["start"], run["length"]))


def dense_text(html: Column, tag_cost: int = TAG_COST) -> Column:
    """The main text of a page by block density: the run of tokens that gains most, a word counting 1 and a tag minus ``tag_cost``.

    Menus, sidebars and footers are many tags around few words and cost more than they bring, so a run that takes them in must
    gain it back beyond them. No element or class name decides. Words of the run are joined by one space and entities
    decoded; null where a page has no words.
    """

    def cut(tokens: Column) -> Column:
        is_word = lambda t: ~F.substring(t, 1, 1).eqNullSafe("<") | (t == "<")
        run = densest_run(F.transform(tokens, lambda t: F.when(is_word(t), F.lit(1)).otherwise(F.lit(-tag_cost))))
        words = let(run, lambda r: F.filter(F.slice(tokens, r["start"] + 1, r["length"]), is_word))
        return empty_to_null(_decoded(F.array_join(words, " ")))

    return let(F.regexp_extract_all(html, F.lit(TOKENS), F.lit(0)), cut)


def main_text(html: Column) -> Column:
    """Body text without scripts, styles, navigation, comments and tags; null when nothing is left."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    names = "|".join(SKIPPED_ELEMENTS)
    text = F.regexp_replace(text, rf"(?is)<({names})\b[^>]*>.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    return empty_to_null(F.trim(F.regexp_replace(_decoded(text), r"[ \t\r\n]+", " ")))
