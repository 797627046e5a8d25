"""Report of a run: summaries and event log from plan, result pages and items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.operators import accounting
from docquay.operators.extraction import DEFAULT_LAYOUT, CardLayout, cards_of
from docquay.operators.failures import UNKNOWN, plan_coverage, retry_worklist
from docquay.plans.landing import Landed
from docquay.plans.transforming import NOT_FOUND
from docquay.sources.event_log import event_line


# --- fixed values: names of events, as readers of the log expect them ---------
STARTED, ENDED, FAILURES = "partition_start", "partition_end", "partition_failures"
LOST, RUN = "download_failed", "run_summary"
READ, WRITTEN, CURRENT = "fetch_metadata", "transform_success", "transform_skipped"
BROKEN, TRANSFORM_RUN = "transform_error", "transform_summary"
STORED, STORED_RUN = "record_stored", "upsert_summary"
UNCOVERED, AGAIN = "partition_uncovered", "retry_planned"
# -----------------------------------------------------------------------------


def item_key() -> list[Column]:
    return [
        F.coalesce("partition_date", F.lit(UNKNOWN)).alias("partition"),
        F.coalesce("body", F.lit(UNKNOWN)).alias("body"),
    ]


def failures_of(items: DataFrame) -> DataFrame:
    return items.where("failed").select(
        *item_key(), F.col("doc_url").alias("url"), "error_code", "reason"
    )


def report_counts(
    plan: DataFrame,
    results: DataFrame,
    items: DataFrame,
    layout: CardLayout = DEFAULT_LAYOUT,
) -> DataFrame:
    """Found, scraped and failed per key. A document with an empty body counts as scraped."""
    found = results.select(
        *accounting.KEY, F.size(cards_of(F.col("html"), layout)).alias("records_found")
    )
    one = F.lit(1)
    scraped = items.where("NOT failed").select(*item_key(), one.alias("records_scraped"))
    failed = items.where("failed").select(*item_key(), one.alias("records_failed"))
    return accounting.key_counts(plan.select(*accounting.KEY), found, scraped, failed)


def event_lines(
    df: DataFrame,
    event: str,
    message: Column,
    *fields: str,
    logger: str,
    at: Column,
    level: str = "INFO",
) -> DataFrame:
    """One line per row, with ``event`` and the given columns as extras."""
    extras = {"event": F.lit(event), **{f: F.col(f) for f in fields}}
    line = event_line(at, F.lit(level), F.lit(logger), message, extras)
    return df.select(line.alias("value"))


def report_events(
    counts: DataFrame, failures: DataFrame, logger: str, at: Column
) -> DataFrame:
    """Event lines of a run: every started key, failure, finished key, and the totals.

    The failures of a key follow its ``partition_end`` as ``partition_failures``
    lines of bounded length instead of one line that grows with them.
    """

    def lines(df, event, message, *fields, level="INFO"):
        return event_lines(df, event, message, *fields, level=level, logger=logger, at=at)

    key = ("partition", "body")
    started = F.format_string("%s, %s: planned", *key)
    return (
        lines(counts.where("started"), STARTED, started, *key)
        .unionByName(lines(
            failures, LOST, F.format_string("no document from %s", "url"),
            *key, "url", "error_code", "reason", level="WARNING",
        ))
        .unionByName(level_lines(counts, logger, at))
        .unionByName(lines(
            accounting.failed_list(failures), FAILURES,
            F.format_string("%s, %s: what was not collected", *key), *key, "chunk", "failures",
        ))
    )


def level_lines(counts: DataFrame, logger: str, at: Column) -> DataFrame:
    """The end of every started key and the totals of the run, from one aggregate."""
    rows = accounting.level_summary(counts)
    key, of_run = ("partition", "body"), {f"total_{c}": F.col(c) for c in accounting.COUNTS}

    def line(event: str, message: Column, extras: dict[str, Column]) -> Column:
        return event_line(at, F.lit("INFO"), F.lit(logger), message, {"event": F.lit(event), **extras})

    ended = line(ENDED, F.format_string(
        "%s, %s: %d listed, %d collected, %d not collected", *key, *accounting.COUNTS
    ), {c: F.col(c) for c in (*key, *accounting.COUNTS)})
    run = line(RUN, F.format_string(
        "%d month(s) and source(s): %d listed, %d collected, %d not collected",
        "partitions_processed", *accounting.COUNTS,
    ), {"partitions_processed": F.col("partitions_processed"), **of_run})
    return rows.select(F.when(F.col("total"), run).otherwise(ended).alias("value"))


def outcome_events(outcomes: DataFrame, logger: str, at: Column) -> DataFrame:
    """Event lines of what a landing run did with each record, and how often it did so."""
    stored = F.format_string("%s: %s", "identifier", "outcome")
    totals = F.format_string("%s: %d record(s)", "outcome", "n_records")
    one = event_lines(outcomes, STORED, stored, "identifier", "outcome", logger=logger, at=at)
    sums = accounting.upsert_summary(outcomes)
    return one.unionByName(event_lines(sums, STORED_RUN, totals, "outcome", "n_records", logger=logger, at=at))


def follow_up_events(plan: DataFrame, items: DataFrame, tries: DataFrame, logger: str, at: Column) -> DataFrame:
    """Event lines of what is left to do: planned keys without a document, and requests to send again.

    ``tries`` has ``url, status, fetched_at`` of every request sent.
    """
    fetched = items.where("NOT failed").select(*item_key())
    missing = plan_coverage(plan, fetched, *accounting.KEY)
    work = retry_worklist(tries)
    key = accounting.KEY
    return event_lines(
        missing, UNCOVERED, F.format_string("%s, %s: nothing collected", *key), *key,
        logger=logger, at=at, level="WARNING",
    ).unionByName(event_lines(
        work.withColumnRenamed("status", "error_code"), AGAIN,
        F.format_string("%s failed with %d, sent again %d time(s) so far", "url", "error_code", "retries"),
        "url", "error_code", "retries", logger=logger, at=at, level="WARNING",
    ))


def whole_report(
    plan: DataFrame, results: DataFrame, fetches: DataFrame, landed: Landed, logger: str, at: Column,
    layout: CardLayout = DEFAULT_LAYOUT,
) -> DataFrame:
    """All event lines of a run that has landed ``fetches`` for the result pages of a plan."""
    counts = report_counts(plan, results, landed.items, layout)
    tries = fetches.select(F.col("doc_url").alias("url"), "status", "fetched_at")
    parts = (
        report_events(counts, failures_of(landed.items), logger, at),
        outcome_events(landed.outcomes, logger, at),
        follow_up_events(plan, landed.items, tries, logger, at),
    )
    return reduce(DataFrame.unionByName, parts)


def transform_events(
    outcomes: DataFrame, summary: DataFrame, start: str, end: str, logger: str, at: Column
) -> DataFrame:
    """Event lines of a transform run: the months read, each record, and the totals."""

    def lines(df, event, message, *fields, level="INFO"):
        return event_lines(df, event, message, *fields, level=level, logger=logger, at=at)

    def having(outcome):
        return outcomes.where(F.col("outcome") == outcome)

    fetched = summary.select(
        F.col("total_records").alias("records_found"),
        F.lit(start[:7]).alias("start_partition"), F.lit(end[:7]).alias("end_partition"),
    )
    missing = F.col("error") == NOT_FOUND
    lost = having("error").where(missing).withColumn("object_name", F.col("file_name"))
    names = ("total_records", "transformed", "skipped", "errors")
    parts = (
        lines(fetched, READ, F.format_string(
            "%d landed record(s), months %s up to %s", *fetched.columns), *fetched.columns),
        lines(having("transformed"), WRITTEN, F.format_string(
            "%s is up to date now", "identifier"), "identifier", "file_type", "file_name"),
        lines(having("skipped"), CURRENT, F.format_string(
            "%s was up to date before", "identifier"), "identifier"),
        lines(having("error").where(~missing), BROKEN, F.format_string(
            "%s stays as it was (%s)", "identifier", "error"), "identifier", "error", level="ERROR"),
        lines(lost, LOST, F.format_string(
            "object %s cannot be read (%s)", "object_name", "error"), "object_name", "error", level="ERROR"),
        lines(summary, TRANSFORM_RUN, F.format_string(
            "%d record(s) looked at: %d written, %d current, %d with errors", *names), *names),
    )
    return reduce(DataFrame.unionByName, parts)
