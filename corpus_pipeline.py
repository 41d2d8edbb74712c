"""The corpus pipeline: five stages over documents, each written and read again as the next one's input.

Rows keep their columns ``doc_id, text, lang, source, n_chars``; other columns of the input are left out. Null and empty
texts have no language and go in the first stage. Every stage but the last returns documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.tables import table
from ledgerloom.llm import decontaminate, language, minhash, packing
from ledgerloom.llm.line_dedup import LineIndex
from ledgerloom.llm.queries import tokenizer_path
from ledgerloom.session import configure, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None  # language inference and tokens are beyond SQL


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language: those for which no language can be inferred."""
    configure(spark)
    docs = docs.select(*COLUMNS)
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    return language.predict(docs, model, COLUMNS).where(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that several documents share out of all but one; every document stays."""
    cleaned = LineIndex(spark).insert_in_batches(docs, 2).clean(docs, carry=("lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near duplicates."""
    gone = minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold passages of the benchmark."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
