"""Benchmark decontamination by winnowing, in DataFrame operations only.

Every window of ``SPAN`` words is represented by the least of its k-gram hashes. Equal windows have equal
least hashes, so a shared span of at least ``SPAN`` words always shares a fingerprint. Long texts are cut into
overlapping segments first, which bounds every array. Fingerprints of documents and of the benchmark are
joined; a hit is then extended over all windows that the fingerprint stands for, and these are compared word
by word, so hash collisions cannot add a hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.binding import let
from ledgerloom.llm.texts import lowered
from ledgerloom.session import written

SPAN = 13
GRAM = 8
SEGMENT = 2048
SHARE = 20  # contaminated from one word in twenty
BROADCAST_PRINTS = 500_000  # about 30 MB as rows of documents
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The stretches between the characters of ``BETWEEN``; splitting there costs about a third of matching each word."""
    return F.coalesce(F.array_remove(F.split(lowered(text), BETWEEN), ""), F.array().cast("array<string>"))


def _paired(values: Column, step: int, combine) -> Column:
    """combine(v[i], v[i + step]) for all i; an array that is too short gives an empty one."""
    return let(
        values,
        lambda v: F.when(
            F.size(v) > step,
            F.zip_with(F.slice(v, 1, F.size(v) - step), F.slice(v, F.lit(step + 1), F.size(v) - step), combine),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def _spread(values: Column, width: int, combine) -> Column:
    """combine over every run of ``width`` values, by doubling; ranges may overlap, as both uses allow it."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values, done = _paired(values, step, combine), done + step
    return values


def window_prints(tokens: Column, span: int) -> Column:
    """For each window of ``span`` words, in order, the least hash among its k-grams."""
    gram = min(GRAM, span)
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    grams = _spread(hashes, gram, lambda a, b: F.xxhash64(a, b))
    return _spread(grams, span - gram + 1, lambda a, b: F.least(a, b))


def _window_texts(tokens: Column, at: Column, span: Column) -> Column:
    return F.array_join(F.slice(tokens, at + 1, span), " ")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of each item, one row for each place: span, hash, window, item_id. Items without id or words have none."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words(F.col("text")).alias("tokens")).where("size(tokens) > 0")
    items = items.withColumn("span", F.least(F.size("tokens"), F.lit(SPAN)))
    prints = reduce(
        lambda rest, n: F.when(F.col("span") == n, window_prints(F.col("tokens"), n)).otherwise(rest),
        range(1, SPAN),
        window_prints(F.col("tokens"), SPAN),
    )
    placed = items.select("item_id", "tokens", "span", F.posexplode(prints).alias("at", "hash"))
    return placed.select("span", "hash", _window_texts(F.col("tokens"), F.col("at"), F.col("span")).alias("window"), "item_id")


def segments(docs: DataFrame) -> DataFrame:
    """Texts in pieces of ``SEGMENT`` window starts, each with the words that its last windows reach into and the whole text's count.

    Every row of ``docs`` has one piece with the base 0, without words too.
    """
    cut = let(
        F.col("tokens"),
        lambda t: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(t) - 1, F.lit(0)), F.lit(SEGMENT)),
            lambda s: F.struct(s.alias("base"), F.size(t).cast("long").alias("n_words"), F.slice(t, s + 1, F.lit(SEGMENT + SPAN - 1)).alias("part")),
        ),
    )
    return docs.select("doc_id", "print", words(F.col("text")).alias("tokens")).select("doc_id", "print", F.inline(cut))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, items (sorted as strings), contaminated.

    A row of ``docs`` is known by ``doc_id`` and its text, so rows that repeat both get equal results and rows that
    repeat only the id are judged each by its own text; null ids are compared as equal. Null or empty texts have no words. Extra columns are ignored.
    One result row per input row. One pass splits all texts: it finds the fingerprints that the benchmark holds, and
    beside them each row keeps its count of words as a mark, a print of span 0 that joins with nothing.

    Tables in between are written as they come from scans and told apart where they are read, or by one task a core: so their
    files are not one for each shuffle partition, and their small size lets Spark broadcast them.
    """
    docs = docs.select("doc_id", "text").withColumn("print", F.xxhash64("text"))
    bench = written(benchmark_windows(benchmark), "benchmark-windows")
    spans = sorted(r.span for r in bench.select("span").distinct().collect())  # at most SPAN values
    mark = F.when(F.col("base") == 0, F.array(F.xxhash64("doc_id", "print"))).otherwise(F.array().cast("array<bigint>"))
    prints = F.array(F.struct(F.lit(0).alias("span"), mark.alias("prints")), *[
        F.struct(F.lit(n).alias("span"), F.array_distinct(window_prints(F.col("part"), n)).alias("prints")) for n in spans
    ])
    own = segments(docs).select("doc_id", "print", "base", "n_words", F.inline(prints)).select(
        "doc_id", "print", "base", "n_words", "span", F.explode("prints").alias("hash")
    )
    matched = own.join(bench.select("span", "hash").distinct().withColumn("hit", F.lit(True)), ["span", "hash"], "left")
    matched = written(matched.where(F.col("hit") | (F.col("span") == 0)), "matched")
    hit_prints = written(matched.where("hit").select("doc_id", "print", "base", "span", "hash"), "matched-prints")
    hits = written(_extended(docs, hit_prints, bench, spans), "hits")

    reach = Window.partitionBy("doc_id", "print").orderBy("at", "end")
    before = F.coalesce(F.max("end").over(reach.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (
        hits.select("doc_id", "print", "at", (F.col("at") + F.col("span")).alias("end")).distinct()
        .withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest("at", before)))
        .groupBy("doc_id", "print").agg(F.sum("fresh").cast("long").alias("n_hit"))
    )
    items = (
        hits.select("doc_id", "print", "window").distinct()
        .join(bench.select("window", F.col("item_id").cast("string").alias("item")).distinct(), "window")
        .groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    found = covered.join(items, _same(covered, items)).select(covered["doc_id"], covered["print"], "n_hit", "items")
    found = written(found.coalesce(docs.sparkSession.sparkContext.defaultParallelism), "found")
    counted = matched.where("span = 0").select("doc_id", "print", "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return counted.join(found, _same(counted, found), "left").select(
        counted["doc_id"], counted["print"].alias("text_hash"), "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["print"] == b["print"])


def _extended(docs: DataFrame, hit_prints: DataFrame, bench: DataFrame, spans: list[int]) -> DataFrame:
    """Windows of the documents that occur in the benchmark word by word: doc_id, print, span, at, window. Rows may repeat.

    The matched prints are broadcast while they are few, so that the texts stay where they are; beyond, Spark chooses.
    """
    of_piece = hit_prints.repartition("doc_id", "print").groupBy("doc_id", "print", "base").agg(F.collect_set(F.struct("span", "hash")).alias("found"))
    of_doc = of_piece.groupBy("doc_id", "print").agg(F.collect_list(F.struct("base", "found")).alias("matched"))
    if hit_prints.count() <= BROADCAST_PRINTS:
        of_doc = F.broadcast(of_doc)
    rows = docs.join(of_doc, _same(docs, of_doc)).select(docs["doc_id"], docs["print"], words(docs["text"]).alias("tokens"), "matched")
    pieces = let(F.col("tokens"), lambda t: F.transform("matched", lambda m: F.struct(
        m["base"].alias("base"), F.slice(t, m["base"] + 1, F.lit(SEGMENT + SPAN - 1)).alias("part"), m["found"].alias("found")
    )))
    with_found = rows.select("doc_id", "print", F.inline(pieces))

    def places(span: int) -> Column:
        wanted = F.transform(F.filter("found", lambda x: x["span"] == span), lambda x: x["hash"])
        chosen = let(wanted, lambda w: F.filter(
            F.transform(window_prints(F.col("part"), span), lambda h, i: F.when(F.array_contains(w, h), i)), lambda i: i.isNotNull()
        ))
        return let(F.col("part"), lambda p: F.transform(chosen, lambda i: F.struct(
            F.lit(span).alias("span"), i.alias("at"), _window_texts(p, i, F.lit(span)).alias("window")
        )))

    if not spans:
        return with_found.select("doc_id", "print", F.lit(0).alias("span"), F.lit(0).alias("at"), F.lit("").alias("window")).limit(0)
    windows = with_found.select("doc_id", "print", "base", F.inline(F.concat(*[places(n) for n in spans])))
    windows = windows.select("doc_id", "print", "span", (F.col("base") + F.col("at")).alias("at"), "window")
    return windows.join(bench.select("window").distinct(), "window", "left_semi")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = decontaminate(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_print")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_print"]), "left_anti")
