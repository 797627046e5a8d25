"""Event log as JSON lines: one object per event."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def utc_iso(ts: Column) -> Column:
    """ISO text of a UTC timestamp without zone, microseconds only when there are any."""
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    micros = F.rpad(F.substring_index(text, ".", -1), 6, "0")
    whole = F.substring_index(text, ".", 1)
    exact = F.when(F.contains(text, F.lit(".")), F.concat(whole, F.lit("."), micros))
    return F.concat(exact.otherwise(text), F.lit("+00:00"))


def event_line(
    timestamp: Column,
    level: Column,
    logger: Column,
    message: Column,
    extras: dict[str, Column] | None = None,
) -> Column:
    """JSON object of the four base fields and the extras, which win over base fields."""
    fields = {
        "timestamp": utc_iso(timestamp),
        "level": level,
        "logger": logger,
        "message": message,
        **(extras or {}),
    }
    row = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.to_json(row, {"ignoreNullFields": "false"})


def log_path(root: str, name: str, started: datetime, run: str | None = None) -> str:
    """One folder of lines per run; ``run`` tells runs of the same second apart."""
    return f"{root}/{name}_{started:%Y%m%d_%H%M%S}_{run or uuid.uuid4().hex}.json"


def write_events(lines: DataFrame, path: str) -> None:
    """``lines`` has the one column ``value``; the driver sees none of them. Nothing is replaced."""
    lines.select("value").write.mode("error").text(path)


BROKEN = "__broken"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not blank, with the file they are in."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.where(F.trim("value") != "")


def _events_of(value: Column, schema: StructType | str) -> Column:
    """An array with the event of a line; empty if it is no JSON object or a field has another type."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = StructType([*schema.fields, StructField(BROKEN, StringType())])
    event = F.from_json(value, kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    return F.filter(F.array(event), lambda e: e.isNotNull() & e[BROKEN].isNull())


def read_events(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Event log with a given schema; fields an event lacks are null.

    Lines that cannot be read are not among the events but in :func:`unreadable_lines`.
    """
    return _lines(spark, path).select(F.inline(_events_of(F.col("value"), schema))).drop(BROKEN)


def unreadable_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """``file, value`` of all lines that :func:`read_events` leaves out, as they are."""
    return _lines(spark, path).where(F.size(_events_of(F.col("value"), schema)) == 0)


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event").agg(F.count(F.lit(1)).alias("n_events"))
