"""Landing of fetched documents as they arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docquay.plans.landing import RUNS, compact, land
from docquay.plans.schemas import FETCHES
from docquay.sources.tables import RunLog


def with_fetch_id(files: DataFrame) -> DataFrame:
    """Identify each fetch by its file and its row there."""
    row = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")
    return files.withColumn("fetch_id", row)


def arriving_fetches(
    spark: SparkSession, path: str, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of fetches from parquet files put below ``path``."""
    schema = StructType([f for f in FETCHES if f.name != "fetch_id"])
    files = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )
    return with_fetch_id(files)


def land_stream(
    fetches: DataFrame, root: str, checkpoint: str, compact_every: int = 50
) -> StreamingQuery:
    """Land everything that has arrived below ``root``, which may hold landed records.

    Every micro-batch is a run of its own with a number of its own. Its tag names the stream
    (a file in the checkpoint folder) and the micro-batch: one that is committed already, and
    is repeated after a failure, is not landed again. Every so many micro-batches the state
    is compacted, so that a run does not read all earlier ones.
    """
    spark = fetches.sparkSession
    stream = _stream_id(spark, checkpoint)

    def land_batch(df: DataFrame, batch: int) -> None:
        tag = f"{stream}-{batch}"
        if RunLog(df.sparkSession, f"{root}/{RUNS}").has(tag):
            return
        land(df.sparkSession, df, root, tag).staging.discard()
        if (batch + 1) % compact_every == 0:
            compact(df.sparkSession, root)

    return (
        fetches.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that the checkpoint belongs to; a lost checkpoint is a new stream."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(checkpoint).getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(path(f"{checkpoint}/stream-*")) or []
    if found:
        return found[0].getPath().getName()
    name = f"stream-{uuid.uuid4().hex}"
    files.mkdirs(path(checkpoint))
    files.createNewFile(path(f"{checkpoint}/{name}"))
    return name
