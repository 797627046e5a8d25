"""Failures as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
UNKNOWN = "unknown"
RETRY_STATUSES = (500, 502, 503, 504, 408, 429)
RETRY_TIMES = 5
# -----------------------------------------------------------------------------


def error_code(status: Column) -> Column:
    """HTTP status of a failed request; 0 when it got no response."""
    return F.coalesce(status, F.lit(0)).cast("int")


def error_reason(status: Column, reason: Column) -> Column:
    return F.when(
        status.isNotNull(), F.concat(F.lit("HTTP "), status.cast("string"))
    ).otherwise(reason)


def classify_failures(
    df: DataFrame, status: str = "status", reason: str = "reason"
) -> DataFrame:
    """Add code and reason; a failure without month or source counts as unknown."""
    return df.withColumns({
        "error_code": error_code(F.col(status)),
        "reason": error_reason(F.col(status), F.col(reason)),
        "partition": F.coalesce("partition", F.lit(UNKNOWN)),
        "body": F.coalesce("body", F.lit(UNKNOWN)),
    })


def is_empty(content: Column) -> Column:
    return F.coalesce(F.length(content), F.lit(0)) == 0


def split_rejected(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to go on with, and rows for quarantine with their ``error``."""
    checked = df.withColumn("error", error)
    return (
        checked.where(F.col("error").isNull()).drop("error"),
        checked.where(F.col("error").isNotNull()),
    )


def retry_worklist(
    tries: DataFrame, key: str = "url", order: tuple[str, ...] = ("fetched_at",)
) -> DataFrame:
    """Requests to send again: last try failed in a retryable way, retries are left.

    ``retries`` is how often the request was already repeated; fresh ones come
    first. An aggregate keeps one row per request, hot ones included.
    """
    last = tries.groupBy(key).agg(
        F.max_by("status", F.struct(*order, "status")).alias("status"),
        (F.count(F.lit(1)) - 1).alias("retries"),
    )
    return last.where(
        F.col("status").isin(*RETRY_STATUSES) & (F.col("retries") < RETRY_TIMES)
    ).orderBy(F.col("retries") > 0, "retries", key)


def plan_coverage(plan: DataFrame, fetched: DataFrame, *key: str) -> DataFrame:
    """Planned keys for which nothing was fetched.

    Each task first keeps one row per fetched key, so a hot key costs one row per task.
    """
    seen = fetched.select(*key).distinct()
    return plan.select(*key).distinct().join(seen, list(key), "left_anti")
