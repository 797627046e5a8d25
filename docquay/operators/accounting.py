"""Counts per month and source, totals and outcome counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ("partition", "body")
COUNTS = ("records_found", "records_scraped", "records_failed")
CHUNK_ROWS = 1000


def started_keys(plan: DataFrame) -> DataFrame:
    return plan.select(*KEY).distinct()


def found_count(result_pages: DataFrame, n_cards: Column) -> DataFrame:
    return result_pages.groupBy(*KEY).agg(F.sum(n_cards).cast("bigint").alias("records_found"))


def scraped_count(documents: DataFrame) -> DataFrame:
    return documents.groupBy(*KEY).agg(F.count(F.lit(1)).alias("records_scraped"))


def failed_count(failures: DataFrame) -> DataFrame:
    return failures.groupBy(*KEY).agg(F.count(F.lit(1)).alias("records_failed"))


def failed_list(failures: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """All failures per key as sorted lists of bounded length.

    Equal failures are first counted (``times``). A key with very many different
    ones gets several chunks, picked by a hash of the failure, so no list holds the
    failures of a whole hot key; joined together the chunks are complete. The number of
    chunks is one row for each such key: that join is a broadcast, or one whose hot
    side adaptive execution can split.
    """
    entry = ["url", "error_code", "reason"]
    hashed = F.substring(F.md5(F.concat_ws("|", *entry).cast("binary")), 1, 8)
    distinct = (
        failures.groupBy(*KEY, *entry)
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("slot", F.conv(hashed, 16, 10).cast("bigint"))
    )
    # Counting by ``times`` keeps both uses of ``distinct`` alike, so its exchange is reused.
    n_distinct = F.count_if(F.col("times") > 0)
    n_chunks = F.call_function("div", n_distinct + (chunk_rows - 1), F.lit(chunk_rows))
    chunks = (
        distinct.groupBy(*KEY).agg(n_chunks.alias("n_chunks")).where(F.col("n_chunks") > 1)
    )
    chunk = F.pmod("slot", F.coalesce("n_chunks", F.lit(1).cast("bigint")))
    return (
        distinct.join(chunks, list(KEY), "left")
        .withColumn("chunk", chunk)
        .groupBy(*KEY, "chunk")
        .agg(
            F.sort_array(F.collect_list(F.struct(*entry, "times"))).alias("failures"),
            F.sum("times").alias("records_failed"),
        )
    )


def _counts(df: DataFrame, column: str) -> DataFrame:
    zeros = [F.lit(0).cast("bigint").alias(c) for c in COUNTS if c != column]
    return df.select(*KEY, F.col(column).cast("bigint").alias(column), *zeros,
                     F.lit(0).alias("started"))


def key_counts(
    plan: DataFrame, found: DataFrame, scraped: DataFrame, failed: DataFrame
) -> DataFrame:
    """All counts per key, planned or not, in one shuffle.

    The inputs carry partial counts, one column each. They are stacked and summed,
    which needs one exchange with map-side sums where joins would need one each.
    """
    zeros = [F.lit(0).cast("bigint").alias(c) for c in COUNTS]
    stacked = plan.select(*KEY, *zeros, F.lit(1).alias("started"))
    for df, column in zip((found, scraped, failed), COUNTS, strict=True):
        stacked = stacked.unionByName(_counts(df, column))
    return stacked.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in COUNTS], (F.max("started") == 1).alias("started")
    )


def partition_summary(counts: DataFrame) -> DataFrame:
    """Counts of every started key, zeros kept, in key order; ``lost`` is the rest."""
    found, scraped, failed = (F.col(c) for c in COUNTS)
    return (
        counts.where("started")
        .select(*KEY, *COUNTS, (found - scraped - failed).alias("records_lost"))
        .orderBy(*KEY)
    )


def run_summary(counts: DataFrame) -> DataFrame:
    """Totals over started keys; failures of other keys stand beside them."""
    started = F.col("started")

    def total(column: str) -> Column:
        return F.coalesce(F.sum(F.when(started, F.col(column))), F.lit(0))

    return counts.agg(
        F.count_if(started).alias("partitions_processed"),
        total("records_found").alias("total_records_found"),
        total("records_scraped").alias("total_records_scraped"),
        total("records_failed").alias("total_records_failed"),
        F.coalesce(F.sum(F.when(~started, F.col("records_failed"))), F.lit(0)).alias(
            "orphan_failures"
        ),
    )


def level_summary(counts: DataFrame) -> DataFrame:
    """Counts of every started key and their totals, in one aggregate.

    ``total`` tells the row of the whole run, whose key is null; ``partitions_processed`` is the
    number of keys that a row stands for.
    """
    sets = counts.where("started").groupingSets([list(KEY), []], *KEY)
    return sets.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
        F.count(F.lit(1)).alias("partitions_processed"), (F.grouping_id() > 0).alias("total"),
    )


def outcome_totals() -> dict[str, Column]:
    """Aggregates over the outcomes of a transform run, also for counting while they are written."""
    outcome = F.col("outcome")
    return {
        "total_records": F.count(F.lit(1)),
        "transformed": F.count_if(outcome == "transformed"),
        "skipped": F.count_if(outcome == "skipped"),
        "errors": F.count_if(outcome == "error"),
    }


def item_totals() -> dict[str, Column]:
    """Aggregates over the items of a landing run: collected, failed, and collected but not storable."""
    return {
        "records_scraped": F.count_if(~F.col("failed")),
        "records_failed": F.count_if(F.col("failed")),
        "records_rejected": F.count_if(~F.col("failed") & F.col("error").isNotNull()),
    }


def transform_summary(outcomes: DataFrame) -> DataFrame:
    """Numbers of transformed, skipped and failed records; no row without records."""
    totals = [c.alias(name) for name, c in outcome_totals().items()]
    return outcomes.agg(*totals).where(F.col("total_records") > 0)


def upsert_summary(merged: DataFrame) -> DataFrame:
    return merged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_records"))
