"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PUSHED_VALUES = 512

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Let every top-k keep its k rows per input task before the shuffle, whatever k is.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    # A list of up to so many values is checked against the statistics and Bloom filters of Parquet files value by value.
    "spark.sql.parquet.pushdown.inFilterThreshold": str(PUSHED_VALUES),
    # Functions over Arrow batches get whole texts; a batch of them stays small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Nor are thousands of whole texts held as one column of a Parquet batch.
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    # Of repeated keys in a JSON answer the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the jobs rely on. Shuffle width is left to the cluster and AQE."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("ledgerloom")
    options = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a single-machine session (``local`` or ``local[...]``) without that setting gets a temporary
    folder; on a cluster each executor would write its part to a disk that no other can read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return f"{shared_folder(spark)}/ledgerloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table written to the shared folder and read back.

    It cuts the lineage: several uses read one result, a lost executor does not bring back the work
    behind it, and Spark knows the table's size when it chooses a join.
    """
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
