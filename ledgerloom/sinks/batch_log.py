"""A table that micro-batches append to, kept in few folders.

Each batch writes a folder named after itself, ``5-5``; a repeated batch replaces it. When 32 batches are full, the folders of the
last 32 are merged into one, ``0-31``; when 32 of those are full, they are merged into ``0-1023``, and so on. A row is thus
rewritten once per factor of 32 of the history, and a reader lists some 32 folders per factor. A batch merges only folders of
batches before it, so what may be replayed is never merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FANOUT = 32
FILE_BYTES = 128 << 20


class BatchLog:
    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), f"{schema}, batch_id bigint"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def ranges(self) -> list[tuple[int, int]]:
        """The batches that each folder holds, in order; folders inside a larger one are left out, for a merge has taken them over."""
        files, root = self._files(), self._path("")
        names = [e.getPath().getName() for e in files.listStatus(root)] if files.exists(root) else []
        found = sorted((int(a), int(b)) for a, b in (n.split("-") for n in names if n[:1].isdigit()))
        return [r for r in found if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in found)]

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Put the rows of a batch in the place of those that it wrote before, then merge what has become full."""
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{self.root}/{batch_id}-{batch_id}")
        size = FANOUT
        while batch_id >= size and batch_id % size == 0:
            self._merge(batch_id - size, batch_id - 1)
            size *= FANOUT

    def _merge(self, first: int, last: int) -> None:
        files, name = self._files(), f"{first}-{last}"
        inside = [(a, b) for a, b in self.ranges() if first <= a and b <= last]
        if inside and not files.exists(self._path(name)):
            size = sum(files.getContentSummary(self._path(f"{a}-{b}")).getLength() for a, b in inside)
            rows = self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{a}-{b}" for a, b in inside])
            rows.coalesce(int(size // FILE_BYTES) + 1).write.mode("overwrite").parquet(f"{self.root}/_merge")
            if not files.rename(self._path("_merge"), self._path(name)):
                raise OSError(f"cannot rename {self.root}/_merge")
        for entry in [e.getPath().getName() for e in files.listStatus(self._path(""))]:
            if entry[:1].isdigit() and entry != name and first <= int(entry.split("-")[0]) and int(entry.split("-")[1]) <= last:
                files.delete(self._path(entry), True)

    def read(self) -> DataFrame:
        """All rows with their ``batch_id``."""
        paths = [f"{self.root}/{a}-{b}" for a, b in self.ranges()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)
