"""The order of landed feed pages from their cursors.

Each page was asked for by a cursor (null for the first page) and names the cursor of the next one. The links are followed by pointer
jumping: in every round each page learns the page twice as far before it, so a feed of n pages takes log2 n rounds of one join on
narrow rows, whatever the order in which pages landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dedup import first_per_key
from ledgerloom.session import written

ORDERED = "ordered"
BREAK = "break"
CYCLE = "cycle"


def _links(pages: DataFrame, feed: str, cursor: str, next_cursor: str, has_next: str) -> DataFrame:
    """One row per page: feed, cursor (empty text for the first page), and the cursor before it, null where there is none."""
    own = F.coalesce(F.col(cursor), F.lit(""))
    follows = F.when(F.coalesce(F.col(has_next), F.lit(False)), F.col(next_cursor))
    rows = pages.select(F.col(feed).alias("feed"), own.alias("cursor"), follows.alias("next"))
    once = first_per_key(rows, ["feed", "cursor"], "next")
    # Two pages that name one successor: the first by cursor counts, so that every page has one place.
    before = once.where("next IS NOT NULL").groupBy("feed", F.col("next").alias("cursor")).agg(F.min("cursor").alias("before"))
    linked = once.join(before, ["feed", "cursor"], "left").select("feed", "cursor", "before")
    return linked.withColumn("before", F.when(F.col("cursor") != "", F.col("before")))


def page_places(
    pages: DataFrame, feed: str = "feed", cursor: str = "cursor", next_cursor: str = "end_cursor", has_next: str = "has_next"
) -> DataFrame:
    """feed, cursor, page (place in its chain, from 0), chain (cursor of the chain's first page) and status, one row per page.

    ``ordered``: the chain starts at the feed's first page. ``break``: it starts at a page that no landed page leads to. ``cycle``:
    the links lead round; such pages have no place. The first page's cursor is null or empty. A page landed several times counts once.
    """
    linked = _links(pages, feed, cursor, next_cursor, has_next)
    start = linked.select("feed", "cursor", F.coalesce("before", "cursor").alias("to"), F.col("before").isNotNull().cast("long").alias("steps"))
    held = written(start.withColumn("open", F.col("steps") > 0), "page-order")
    n = held.groupBy("feed").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(1, n).bit_length()):  # after this many doublings only a cycle can still be open
        if held.where("open").isEmpty():
            break
        ahead = held.select("feed", F.col("cursor").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("open").alias("_open"))
        jumped = held.join(ahead, ["feed", "to"])
        held = written(
            jumped.select("feed", "cursor", F.col("_to").alias("to"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_open").alias("open")),
            "page-order",
        )
    status = F.when(F.col("open"), F.lit(CYCLE)).when(F.col("to") == "", F.lit(ORDERED)).otherwise(F.lit(BREAK))
    known = ~F.col("open")
    return held.select(
        "feed", "cursor", F.when(known, F.col("steps")).alias("page"), F.when(known, F.col("to")).alias("chain"), status.alias("status")
    )
