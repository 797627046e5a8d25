"""Shared folders for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def staging_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir`` of the session.

    Where the session names none, ``fallback`` (a folder of the tables at hand) is
    used; a local session may make a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named
    if fallback:
        return f"{fallback}/staging"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="docquay-")
    raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")


class Staging:
    """Intermediate tables of one run, in a folder of their own."""

    def __init__(self, spark: SparkSession, fallback: str | None = None) -> None:
        self.spark = spark
        self.root = f"{staging_root(spark, fallback)}/staged-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and go on from the written table.

        Later steps neither recompute it nor depend on executors that may be lost.
        """
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def counted(self, df: DataFrame, name: str, **totals: Column) -> tuple[DataFrame, dict[str, int]]:
        """:meth:`table`, and aggregates of its rows that are taken while they are written."""
        seen = Observation(name)
        written = self.table(df.observe(seen, *[c.alias(n) for n, c in totals.items()]), name)
        return written, seen.get

    def drop(self, name: str) -> None:
        """Delete one table that nothing reads any more."""
        self._delete(f"{self.root}/{name}")

    def discard(self) -> None:
        """Delete the folder, once nothing reads its tables any more."""
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
