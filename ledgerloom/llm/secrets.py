"""Multipart credential linking, in DataFrame operations only.

Strong patterns (assigned secrets, access ids, hex keys) are always reported. Weak parts are reported only where
complementary parts occur together in one scope of ``SCOPE`` characters: a weak key next to an access id or an
endpoint, a weak id next to a secret, an endpoint next to both. Parts are linked by an interval join: each part covers
the character range that it can be linked over, ranges meet in bins, and a semi join per role answers whether one is
there, so no pairs are made.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import written

SCOPE = 400
BIN = 2048
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: kind -> (pattern, group measured, least length of it, role); the order is the order of kinds at one start.
KINDS = {
    "assign": (ASSIGN, 2, 6, "secret"),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, "id"),
    "hex": (r"[0-9a-f]+", 0, 24, "secret"),
    "weakid": (r"(?:(?i)client|account|user|access_?key)[_-]?(?i:id|name)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]+", 0, 10, "id"),
    "weakkey": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]+", 0, 32, "secret"),
    "endpoint": (r"[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]+", 0, 8, "endpoint"),
}
BASE = ("assign", "access", "hex")
ORDER = {kind: i for i, kind in enumerate(KINDS)}
KEY = ["doc_id", "print"]


def _may_hold(kind: str) -> Column:
    """A cheap test that every text with a match of this kind passes."""
    text = F.col("text")
    if kind == "assign":
        low = F.lower(text)
        return reduce(lambda a, b: a | b, [low.contains(k) for k in KEYWORDS])
    if kind == "hex":
        return text.rlike("[0-9a-f]{24}")
    if kind == "weakid":
        return F.lower(text).rlike("(?:client|account|user|access_?key)[_-]?(?:id|name)")
    if kind == "weakkey":
        return text.rlike("[A-Za-z0-9+/_-]{32}")
    return text.contains({"access": "AKIA", "endpoint": "://"}[kind])


def _matches(kind: str) -> Column:
    """Every match in order, with the text between it and the match before: array of (kind, i, gap, long, size)."""
    pattern, group, _, _ = KINDS[kind]
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split("text", pattern, -1), lambda x: F.char_length(x))
    sizes = F.transform(found, lambda x: F.char_length(x))
    lengths = F.transform(measured, lambda x: F.char_length(x)) if group else sizes
    rows = F.transform(
        F.slice(F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), lengths.alias("measured")), F.lit(1), F.size(found)),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["size"].alias("size"), x["measured"].alias("measured")),
    )
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,size:int,measured:int>>")
    return F.when(_may_hold(kind), rows).otherwise(none)


def parts(docs: DataFrame) -> DataFrame:
    """All strong and weak parts: doc_id, print, kind, rank, role, start, end (code points, end exclusive)."""
    rows = docs.where(F.length("text") > 0).select(*KEY, F.inline(F.concat(*[_matches(kind) for kind in KINDS]))).distinct()
    until = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy(*KEY, "kind").orderBy("i"))
    least = reduce(lambda rest, k: F.when(F.col("kind") == k, KINDS[k][2]).otherwise(rest), KINDS, F.lit(0))
    kinds = F.create_map(*chain.from_iterable((F.lit(k), F.struct(F.lit(ORDER[k]).alias("rank"), F.lit(v[3]).alias("role"))) for k, v in KINDS.items()))
    return (
        rows.select("*", until.alias("end")).where(F.col("measured") >= least)
        .select(*KEY, "kind", kinds[F.col("kind")].alias("k"), (F.col("end") - F.col("size")).alias("start"), "end")
        .select(*KEY, "kind", "k.rank", "k.role", "start", "end")
    )


def _near(weak: DataFrame, others: DataFrame) -> DataFrame:
    """The weak parts that have one of the others, itself and what it overlaps apart, within the scope."""
    low, high = F.greatest(F.col("start") - SCOPE, F.lit(0)), F.col("end") + SCOPE
    covering = others.select(*[F.col(c).alias(f"o_{c}") for c in KEY], F.col("start").alias("o_start"), F.col("end").alias("o_end"),
                             F.explode(F.sequence(F.floor(low / BIN), F.floor(high / BIN))).alias("o_bin"))
    # what follows a weak part is near its end, what goes before near its start, and a long part has them in different bins
    weak = weak.withColumn("bin", F.explode(F.array_distinct(F.array(F.floor(F.col("start") / BIN), F.floor(F.col("end") / BIN)))))
    on = (
        F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("print") == F.col("o_print")) & (F.col("bin") == F.col("o_bin"))
        & (((F.col("start") >= F.col("o_end")) & (F.col("start") <= F.col("o_end") + SCOPE)) | ((F.col("o_start") >= F.col("end")) & (F.col("o_start") <= F.col("end") + SCOPE)))
    )
    return weak.join(covering, on, "left_semi").drop("bin").distinct()


def linked(found: DataFrame) -> DataFrame:
    """The weak parts among ``found`` that complementary parts vouch for."""
    weak = found.where(~F.col("kind").isin(*BASE))
    ids, keys, ends = (found.where(F.col("role") == r) for r in ("id", "secret", "endpoint"))
    weak_keys = _near(weak.where("role = 'secret'"), ids.unionByName(ends))
    weak_ids = _near(weak.where("role = 'id'"), keys)
    endpoints = _near(_near(weak.where("role = 'endpoint'"), ids), keys)
    return weak_keys.unionByName(weak_ids).unionByName(endpoints)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base (spans as kind:start:end, comma-joined) and spans (with the linked ones).

    A row is known by ``doc_id`` and its text; rows that repeat both get equal results. Null text counts as empty and has
    no spans. Extra columns are ignored.
    """
    docs = docs.select("doc_id", "text").withColumn("print", F.xxhash64("text"))
    found = written(parts(docs), "secret-parts")
    base = found.where(F.col("kind").isin(*BASE))
    spans = base.withColumn("base", F.lit(True)).unionByName(linked(found).withColumn("base", F.lit(False)))
    text = lambda rows: F.array_join(F.transform(F.array_sort(rows), lambda x: x["span"]), ",")
    row = F.struct("start", "rank", F.concat_ws(":", "kind", "start", "end").alias("span"))
    of_doc = spans.groupBy(*KEY).agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        text(F.collect_list(F.when(F.col("base"), row))).alias("base"),
        text(F.collect_list(row)).alias("spans"),
    )
    same = docs["doc_id"].eqNullSafe(of_doc["doc_id"]) & (docs["print"] == of_doc["print"])
    return docs.drop("text").join(of_doc, same, "left").select(
        docs["doc_id"],
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.coalesce("base", F.lit("")).alias("base"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
