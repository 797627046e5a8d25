"""Sources to collect from, given as ``name:id,name:id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_sources(text: Column) -> Column:
    """Array of ``(body, body_id)``, trimmed; anything behind a second ``:`` is ignored."""
    return F.transform(
        F.split(text, ","),
        lambda pair: F.struct(
            F.trim(F.split(pair, ":")[0]).alias("body"),
            F.trim(F.get(F.split(pair, ":"), F.lit(1))).alias("body_id"),
        ),
    )


def source_registry(spark: SparkSession, text: str) -> DataFrame:
    """One row per source; a name given twice keeps its last id."""
    rows = spark.range(1).select(
        F.posexplode(parse_sources(F.lit(text))).alias("at", "source")
    )
    return (
        rows.groupBy(F.col("source.body").alias("body"))
        .agg(F.max_by("source.body_id", "at").alias("body_id"), F.min("at").alias("at"))
        .select("body", "body_id", "at")
    )
