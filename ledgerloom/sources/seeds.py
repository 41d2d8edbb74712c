"""Small dimensions built from the fixed values.

They enter as Arrow tables, so that Spark knows their size and can broadcast them on that ground.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom import fixed_values as fv


def seed_names(spark: SparkSession, names: dict[str, list[str]] | None = None) -> DataFrame:
    """``canonical, aliases, seq``; pass a table of the same shape to the resolver for larger seeds."""
    table = fv.SEED_NAMES if names is None else names
    return spark.createDataFrame(
        pa.table(
            {
                "canonical": pa.array(table.keys(), pa.string()),
                "aliases": pa.array(table.values(), pa.list_(pa.string())),
                "seq": pa.array(range(len(table)), pa.int32()),
            }
        )
    )


def board_candidates(
    spark: SparkSession, candidates: dict[str, list[tuple[str, str]]] | None = None
) -> DataFrame:
    """``company, rank, platform, token`` in trying order."""
    items = (fv.BOARD_CANDIDATES if candidates is None else candidates).items()
    rows = [
        (company, rank, platform, token)
        for company, boards in items
        for rank, (platform, token) in enumerate(boards)
    ]
    names = ("company", "rank", "platform", "token")
    types = (pa.string(), pa.int32(), pa.string(), pa.string())
    columns = {n: pa.array([row[i] for row in rows], t) for i, (n, t) in enumerate(zip(names, types))}
    return spark.createDataFrame(pa.table(columns))


def labels(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    """A one-column dimension, used to fill counts with zeros."""
    return spark.createDataFrame(pa.table({name: pa.array(values, pa.string())}))
