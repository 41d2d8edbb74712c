"""The registered queries of the numbered operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.tables import table
from ledgerloom.llm import decontaminate, embeddings, filter_audit, fingerprints, hard_negatives, language, minhash, packing, pages, secrets, sharding, suffixes
from ledgerloom.llm.line_dedup import LineIndex
from ledgerloom.llm.oracles import ORACLE  # noqa: F401


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_pack(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer_path())


def op3_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf, "embeddings"))


def op4_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    cleaned = LineIndex(spark).insert_in_batches(docs, 2).clean(docs)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract(table(spark, sf, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"))



def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))



def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings"), label)



def op13_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf, "documents"))


QUERIES = {q.__name__: q for q in (op1_decontaminate, op2_pack, op3_embeddings, op4_minhash, op5_line_dedup, op6_shards, op7_suffixes, op8_pages, op9_secrets, op10_language, op11_filter_audit, op12_hard_negatives, op13_fingerprints)}
