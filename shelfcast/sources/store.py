"""Stage tables kept as Parquet under one root, reports as CSV, models beside them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


class TableStore:
    """Named tables under ``root``, a folder all executors reach.

    A table is a folder of parts and a pointer file that names those that count, one a line.  A write goes
    to a new part; the pointer is replaced last, in one step, so a reader sees the old rows or the new ones,
    a crash leaves the old ones, and a write that is tried again adds its rows once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, path: str):
        """The file system of the store, and a path on it."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), at

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/_CURRENT"

    def parts(self, name: str) -> list[str]:
        """The folders of the parts that count, oldest first."""
        files, pointer = self._at(self._pointer(name))
        if not files.exists(pointer):
            raise FileNotFoundError(f"table {name} is not in {self.root}; build it first")
        stream = files.open(pointer)
        try:
            named = bytes(stream.readAllBytes()).decode().split()
        finally:
            stream.close()
        return [f"{self.root}/{name}/{part}" for part in named]

    def exists(self, name: str) -> bool:
        """Whether the table was written to the end."""
        files, pointer = self._at(self._pointer(name))
        return files.exists(pointer)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(*self.parts(name))

    def replace(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = (), cluster_by: tuple[str, ...] = ()) -> bool:
        """Replaces a table; an empty frame is not kept and the old table stays.

        The plan runs once and may read the table it replaces.  With ``cluster_by`` rows with equal keys
        go to one file, sorted, so a scan for one key skips all others by their statistics.
        """
        version = f"v-{uuid.uuid4().hex[:12]}"
        fresh = f"{self.root}/{name}/{version}"
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        df.write.partitionBy(*partition_by).parquet(fresh)
        files, new = self._at(fresh)
        if self.spark.read.schema(df.schema).parquet(fresh).isEmpty():
            files.delete(new, True)
            return False
        self._point(name, [version])
        return True

    def _point(self, name: str, counts: list[str]) -> None:
        """Makes the parts ``counts`` those that count; others but the ones before them are removed."""
        files, pointer = self._at(self._pointer(name))
        kept = {*counts, *(part.rsplit("/", 1)[-1] for part in (self.parts(name) if files.exists(pointer) else []))}
        out = files.create(pointer, True)
        out.write(bytearray("\n".join(counts).encode()))
        out.close()
        for status in files.listStatus(pointer.getParent()):
            folder = status.getPath().getName()
            if folder.startswith("v-") and folder not in kept:
                files.delete(status.getPath(), True)

    def append(self, name: str, df: DataFrame) -> None:
        """Adds rows, matched to the table by column name, as a part of their own."""
        before = [part.rsplit("/", 1)[-1] for part in self.parts(name)]
        version = f"v-{uuid.uuid4().hex[:12]}"
        df.select(*self.read(name).columns).write.parquet(f"{self.root}/{name}/{version}")
        self._point(name, [*before, version])

    def cached(self, name: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
        """The stored table, built when absent or forced."""
        if force or not self.exists(name):
            self.replace(name, build())
        return self.read(name)

    def report(self, name: str, df: DataFrame) -> str:
        """A small result as one CSV file with a header."""
        path = f"{self.root}/reports/{name}"
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        return path
