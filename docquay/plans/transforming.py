"""Landing zone to transformed zone, for a range of months."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquay.functions.markup import clean_html, html_from_bytes
from docquay.functions.naming import (
    TRANSFORMED_ZONE,
    UNCLEANED_TYPES,
    content_hash,
    mime_type,
    object_key,
    object_name,
    object_path,
)
from docquay.operators.accounting import outcome_totals
from docquay.operators.state import month_range_scan, require_unique, stored_rows_of, upsert
from docquay.plans import landing
from docquay.plans.schemas import (
    ARRIVAL,
    LANDING_FIELDS,
    REQUIRED_FIELDS,
    TRANSFORMED,
    TRANSFORMED_FIELDS,
    table,
)
from docquay.sources.staging import Staging
from docquay.sources.tables import (
    BATCH,
    RunLog,
    append_batch,
    current_rows,
    read_batches,
)

RUNS, METADATA, INDEX = "transformed_runs", "transformed_metadata", "transformed_objects"
CONTENT, QUARANTINE = "transformed_content", "transformed_quarantine"
NOT_FOUND = "content not found"
FAILED = table("identifier", "error")
#: Landing runs that a change run has looked at, kept with its number.
READ = "read"


def transformed_name() -> Column:
    return object_name(F.col("identifier"), F.coalesce("file_type", F.lit("html")))


def mark_skipped(landed: DataFrame, done: DataFrame) -> DataFrame:
    """Landed records with ``skipped``: already transformed from the present hash."""
    known = done.select("identifier", "source_hash", F.lit(True).alias("__done"))
    same = F.col("__done").isNotNull() & F.col("file_hash").eqNullSafe(F.col("source_hash"))
    return landed.join(known, "identifier", "left").select(
        *landed.columns, same.alias("skipped")
    )


def record_error() -> Column:
    """What keeps a pending record from being transformed; null when nothing does."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in REQUIRED_FIELDS])
    )
    return F.when(
        F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))
    )


def transform_content(records: DataFrame) -> DataFrame:
    """Replace ``content`` by its transformed bytes.

    PDF and DOC pass through; everything else is cleaned as HTML. Only the HTML
    rows are decoded: a null page costs the cleaning steps nothing.
    """
    passes = F.coalesce(F.col("file_type"), F.lit("html")).isin(*UNCLEANED_TYPES)
    page = F.when(~passes, html_from_bytes(F.col("content")))
    cleaned = clean_html(records.withColumn("__html", page), "__html", "__cleaned")
    return cleaned.withColumn(
        "content",
        F.when(passes, F.col("content")).otherwise(F.col("__cleaned").cast("binary")),
    ).drop("__html", "__cleaned")


def transformed_records(records: DataFrame, new_hash: str = "new_hash") -> DataFrame:
    """Metadata of transformed records: defaults, new path and hash, and lineage."""
    empty = F.lit("")
    order = [c for c in ARRIVAL if c in records.columns]
    return records.withColumns({
        "title": F.coalesce("title", empty),
        "source_hash": F.coalesce("file_hash", empty),
        "file_hash": F.col(new_hash),
        "file_path": object_path(TRANSFORMED_ZONE, transformed_name()),
    }).select(*TRANSFORMED_FIELDS, *order)


@dataclass(frozen=True)
class Transformed:
    """What a run did: the outcome of every record, and the totals, counted while those were written.

    Outcomes read tables of ``staging``; discard that when they are no longer read.
    """

    batch: int
    outcomes: DataFrame
    summary: DataFrame
    staging: Staging


def read_landed(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """Current landing records of the months; files of other months are not read."""
    history = month_range_scan(landing.landed_history(spark, root), start, end)
    return current_rows(history, "identifier", *ARRIVAL).select(*LANDING_FIELDS, *ARRIVAL)


def transformed_history(spark: SparkSession, root: str) -> DataFrame:
    log = RunLog(spark, f"{root}/{RUNS}")
    return landing.read_records(spark, log, f"{root}/{METADATA}", TRANSFORMED, log.state())


def transformed_rows(spark: SparkSession, root: str) -> DataFrame:
    """Current records of the transformed zone."""
    rows = current_rows(transformed_history(spark, root), "identifier", *ARRIVAL)
    return rows.select(*TRANSFORMED_FIELDS)


def transform(spark: SparkSession, root: str, start: str, end: str) -> Transformed:
    """Bring the transformed zone up to date for the months of ``start`` to ``end``, as one run.

    Keys and hashes decide first. Stored state is reduced to the landed keys before it is
    aggregated; content is read for pending records only, from the batches that hold it,
    and cleaned once, on its way to the content table. The commit comes last. Of two versions
    of a record that runs transform side by side, the one that was landed last counts.
    """
    run = TransformRun(spark, root)
    return run.finish(read_landed(spark, root, start, end), landing.landed_index(spark, root))


def unread_runs(spark: SparkSession, root: str) -> tuple[list[int], list[int]]:
    """Landing runs that no change run of the transformed zone has looked at, and those to read for them.

    What a base has replaced is read from the run itself; only where that is gone, from the bases
    that hold its rows.
    """
    landed, log = RunLog(spark, f"{root}/{landing.RUNS}"), RunLog(spark, f"{root}/{RUNS}")
    looked_at = {n for run in log.committed() for n in log.noted(run, READ)}
    bases = landed.bases()
    unread = [n for n in landed.committed() if n not in looked_at]
    there = {n for n in {*unread, *bases} if landing.has_metadata(spark, root, n)}
    gone = {n for n in unread if n not in bases and n not in there}

    def held(base: int) -> set[int]:
        return set().union(*[held(n) | {n} if n in bases else {n} for n in bases[base]])

    needed = [n for n in bases if n in there and gone & held(n)]
    return unread, sorted({*needed, *[n for n in unread if n in there and n not in bases]})


def failed_keys(spark: SparkSession, root: str) -> DataFrame:
    """Identifiers that the runs since the last change run, and that one, could not transform."""
    log = RunLog(spark, f"{root}/{RUNS}")
    runs = log.committed()
    last = max((n for n in runs if log.noted(n, READ)), default=0)
    failed = read_batches(spark, f"{root}/{QUARANTINE}", FAILED, [n for n in runs if n >= last])
    return failed.select("identifier").distinct()


def transform_changes(spark: SparkSession, root: str) -> Transformed:
    """Bring the transformed zone up to date with the landing runs it has not looked at, as one run.

    Only the rows of those runs are read, and their months, whatever the size of the zone. Records
    that could not be transformed are tried again; only for these earlier runs are read. Which runs
    were read is kept with the commit, so a lost run is done again as a whole.
    """
    run = TransformRun(spark, root)
    unread, needed = unread_runs(spark, root)
    history, index = (read(spark, root, needed) for read in (landing.landed_history, landing.landed_index))
    failed = run.work.table(failed_keys(spark, root), "failed")
    if not failed.isEmpty():
        again = stored_rows_of(landing.landed_history(spark, root), failed, "identifier")
        known = landing.landed_index(spark, root)
        objects = current_rows(again, "identifier", *ARRIVAL).select(
            object_key(F.col("file_path")).alias("file_name"))
        history = history.unionByName(again)
        index = index.unionByName(stored_rows_of(known, objects, "file_name"))
    landed = current_rows(history, "identifier", *ARRIVAL).select(*LANDING_FIELDS, *ARRIVAL)
    return run.finish(landed, index, unread)


class TransformRun:
    """One run into the transformed zone, over landed records and the index rows of their objects."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.log = RunLog(spark, f"{root}/{RUNS}")
        self.batch = self.log.claim()
        self.seen = self.log.committed()
        self.history = transformed_history(spark, root)
        self.work = Staging(spark, root)

    def finish(self, landed: DataFrame, index: DataFrame, read: list[int] = ()) -> Transformed:
        """Transform what is pending and commit; ``read`` are the landing runs it comes from."""
        spark, root, batch, work = self.spark, self.root, self.batch, self.work
        content_root = f"{root}/{CONTENT}"
        landed = work.table(landed, "landed")
        stored = stored_rows_of(self.history, landed, "identifier")
        stored = work.table(current_rows(stored, "identifier", *ARRIVAL), "stored")
        records = work.table(
            mark_skipped(landed, stored).withColumn("file_name", object_key(F.col("file_path"))), "records"
        )
        pending = records.where(~F.col("skipped") & record_error().isNull())
        entries = stored_rows_of(index, pending, "file_name")
        wanted = landing.current_objects(entries).select("file_name", "content_batch")
        wanted = work.table(wanted, "wanted")
        cleaned = transform_content(
            landing.content_of(spark, root, wanted)
            .withColumn("file_type", F.substring_index("file_name", ".", -1))
        )
        append_batch(
            cleaned.select("file_name", "content", content_hash(F.col("content")).alias("new_hash")),
            content_root,
            batch,
            key="file_name",
        )

        written = spark.read.parquet(f"{content_root}/{BATCH}={batch}").select("file_name", "new_hash")
        outcomes, totals = work.counted(
            records.join(written, "file_name", "left")
            .withColumn("error", F.when(~F.col("skipped"), F.coalesce(
                record_error(), F.when(F.col("new_hash").isNull(), F.lit(NOT_FOUND))
            )))
            .withColumn(
                "outcome",
                F.when(F.col("skipped"), "skipped")
                .when(F.col("error").isNotNull(), "error")
                .otherwise("transformed"),
            ),
            "outcomes",
            **outcome_totals(),
        )
        fresh = outcomes.where(F.col("outcome") == "transformed")
        require_unique(fresh, "identifier")
        objects = fresh.select(
            transformed_name().alias("file_name"),
            mime_type(F.coalesce("file_type", F.lit("html"))).alias("content_type"),
            F.col("new_hash").alias("file_hash"),
        )
        append_batch(objects, f"{root}/{INDEX}", batch)
        failed = outcomes.where(F.col("outcome") == "error").select("identifier", "error")
        append_batch(failed, f"{root}/{QUARANTINE}", batch)
        merged = work.table(
            upsert(
                stored, transformed_records(fresh), "identifier", TRANSFORMED_FIELDS,
                keep_untouched=False, order=ARRIVAL,
            ),
            "merged",
        )
        changes = landing.metadata_changes(merged, stored, ARRIVAL)
        landing.append_records(changes, self.log, f"{root}/{METADATA}", TRANSFORMED, batch)
        self.log.note(batch, READ, read)
        landing.commit_run(spark, self.log, batch, self.seen, f"{root}/{METADATA}", TRANSFORMED)
        told = outcomes.select(
            "identifier", "outcome", "error", F.coalesce("file_type", F.lit("html")).alias("file_type"),
            transformed_name().alias("file_name"),
        )
        one = spark.range(1 if totals["total_records"] else 0)
        summary = one.select(*[F.lit(n).cast("bigint").alias(c) for c, n in totals.items()])
        return Transformed(batch, told, summary, work)
