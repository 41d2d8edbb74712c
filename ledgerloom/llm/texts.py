"""Shared by the operators: ASCII white space and lower-casing of A-Z, compressed texts of chosen documents, word tables of workers."""

from __future__ import annotations

from collections.abc import Iterator, MutableMapping

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import written

SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


BROADCAST_IDS = 2_000_000  # 16 MB of ids


def zipped(text: str) -> bytes:
    return zstandard.compress(text.encode("utf-8", "surrogatepass"), 3)


def unzipped(data: bytes) -> str:
    return zstandard.decompress(data).decode("utf-8", "surrogatepass")


def rows_of(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the given ids (distinct, column ``doc_id``).

    The ids are broadcast while they are few, so that the other rows stay where they are; beyond, both sides are shuffled.
    """
    ids = written(ids, "wanted-ids")
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """A table of ``doc_id`` and ``data``, the compressed texts of the given ids (distinct, column ``doc_id``)."""

    def zip_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [zipped(t or "") for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows_of(given, ids).mapInArrow(zip_up, "doc_id long, data binary"), "wanted-texts")


_held: list[MutableMapping] = []


def hold_only(table: MutableMapping | None) -> None:
    """Empty the word table that this worker held for another operator: workers outlive their stages, and one table fits beside the heap.

    Operators that read whole texts without a table of their own hold none.
    """
    if _held and _held[0] is not table:
        _held[0].clear()
    _held[:] = [] if table is None else [table]
