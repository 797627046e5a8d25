"""Result pages to document requests, and fetched documents to the landing zone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docquay.functions.naming import (
    LANDING_ZONE,
    file_type,
    landing_hash,
    mime_type,
    object_name,
    object_path,
)
from docquay.operators import failures
from docquay.operators.accounting import item_totals
from docquay.operators.extraction import (
    DEFAULT_LAYOUT,
    CardLayout,
    base_url,
    card_fields,
    explode_cards,
    missing_field,
    with_document_url,
)
from docquay.operators.state import (
    INSERTED,
    UNCHANGED,
    UPDATED,
    changed_objects,
    last_arrival,
    pick_rows,
    require_unique,
    stored_rows_of,
    upsert,
)
from docquay.plans.schemas import (
    ARRIVAL,
    ITEM_FIELDS,
    LANDING,
    LANDING_FIELDS,
    OBJECT_CONTENT,
    OBJECT_INDEX,
)
from docquay.sources.staging import Staging
from docquay.sources.tables import (
    BATCH,
    DELETED,
    STATE_BUCKETS,
    RunLog,
    append_batch,
    append_state,
    current_rows,
    latest_rows,
    read_batches,
    read_state,
    with_keys,
    with_markers,
)

RUNS, METADATA, INDEX = "landing_runs", "landing_metadata", "landing_objects"
CONTENT, QUARANTINE = "landing_content", "landing_quarantine"
MONTH_FIRST = ("partition_date",)


def card_requests(
    results: DataFrame, layout: CardLayout = DEFAULT_LAYOUT
) -> tuple[DataFrame, DataFrame]:
    """Document requests of all cards, and the cards dropped with their reason."""
    based = results.withColumn("page_url", base_url(F.col("html"), F.col("page_url")))
    cards = card_fields(explode_cards(based, "html", layout), layout)
    kept, dropped = failures.split_rejected(cards, missing_field())
    requests = with_document_url(kept).withColumnRenamed("partition", "partition_date")
    return requests.select(*ITEM_FIELDS, "page", "position"), dropped


def landing_items(fetches: DataFrame) -> DataFrame:
    """Every fetch without its content: type, hash, object name and what went wrong.

    This is the one pass over all content; HTML is parsed here only.
    """
    status, content = F.col("status"), F.col("content")
    failed = ~F.coalesce(status.between(200, 299), F.lit(False))
    reason = failures.error_reason(status, F.col("reason"))
    error = (
        F.when(failed, F.coalesce(reason, F.lit("failed")))
        .when(F.coalesce("identifier", F.lit("")) == "", "identifier missing")
        .when(failures.is_empty(content), "no file content")
    )
    hashed = F.when(error.isNull(), landing_hash(content, F.col("file_type")))
    return (
        fetches.withColumn("file_type", file_type(F.col("content_type")))
        .withColumn("file_name", object_name(F.col("identifier"), F.col("file_type")))
        .select(
            *ITEM_FIELDS,
            *ARRIVAL,
            "file_type",
            "file_name",
            object_path(LANDING_ZONE, F.col("file_name")).alias("file_path"),
            hashed.alias("file_hash"),
            failed.alias("failed"),
            F.when(failed, failures.error_code(status)).alias("error_code"),
            F.when(failed, reason).alias("reason"),
            error.alias("error"),
        )
    )


def storable(items: DataFrame) -> DataFrame:
    return items.where(F.col("error").isNull())


def rejected_items(items: DataFrame) -> DataFrame:
    """Fetches that are not landed, each with its error."""
    return items.where(F.col("error").isNotNull()).select(
        "identifier", "doc_url", F.col("partition_date").alias("partition"), "body",
        "error_code", "error",
    )


def arrived_objects(items: DataFrame) -> DataFrame:
    """Last arrival of each object."""
    arrived = storable(items).select("file_name", "file_hash", *ARRIVAL)
    return last_arrival(arrived, "file_name", *ARRIVAL)


def objects_to_write(items: DataFrame, stored: DataFrame) -> DataFrame:
    """Last arrival of each object, where it is new or changed and not older than the stored one."""
    return changed_objects(newer_objects(arrived_objects(items), stored), stored)


def newer_objects(arrived: DataFrame, stored: DataFrame) -> DataFrame:
    """Arrivals that no stored object is later than."""
    later = F.struct(*[F.col(f"s.{c}") for c in ARRIVAL]) > F.struct(*[F.col(f"a.{c}") for c in ARRIVAL])
    same = F.col("a.file_name") == F.col("s.file_name")
    return arrived.alias("a").join(stored.alias("s"), same & later, "left_anti")


def records_to_merge(items: DataFrame) -> DataFrame:
    """Last arrival of each identifier with the fields of the landing zone."""
    records = storable(items).select(*LANDING_FIELDS, *ARRIVAL)
    return last_arrival(records, "identifier", *ARRIVAL)


def object_content(fetches: DataFrame) -> DataFrame:
    name = object_name(F.col("identifier"), file_type(F.col("content_type")))
    return fetches.select(name.alias("file_name"), "content")


def index_changes(
    arrived: DataFrame, changed: DataFrame, stored: DataFrame, batch: int
) -> DataFrame:
    """Index rows of a run: changed objects with this batch's content, others with a later arrival.

    An object that came again unchanged keeps its content where it is, but later arrivals
    must be compared with this one.
    """
    kind = mime_type(F.substring_index("file_name", ".", -1)).alias("content_type")
    facts = ["file_name", kind, "file_hash"]
    fresh = changed.select(*facts, F.lit(batch).alias("content_batch"), *ARRIVAL)
    again = (
        arrived.join(changed.select("file_name"), "file_name", "left_anti")
        .join(stored.select("file_name", "content_batch"), "file_name")
        .select(*facts, "content_batch", *ARRIVAL)
    )
    return fresh.unionByName(again)


def current_objects(index: DataFrame) -> DataFrame:
    """Last arrival of each object; ``content_batch`` says where its bytes are."""
    return latest_rows(index, "file_name", *[F.col(c) for c in ARRIVAL], F.col(BATCH))


def metadata_changes(
    merged: DataFrame, stored: DataFrame, order: tuple[str, ...] = ()
) -> DataFrame:
    """Rows to append: what came in and is not older, and a mark where a record has moved away.

    Without ``order`` unchanged records need no row.
    """
    written = [INSERTED, UPDATED, *([UNCHANGED] if order else [])]
    changed = merged.where(F.col("outcome").isin(*written))
    moved = (
        changed.where(F.col("outcome") == UPDATED)
        .select("identifier", F.col("partition_date").alias("__now"), *order)
        .join(stored.select("identifier", "partition_date"), "identifier")
        .where(~F.col("partition_date").eqNullSafe(F.col("__now")))
        .select("identifier", "partition_date", *order, F.lit(True).alias(DELETED))
    )
    return (
        changed.drop("outcome")
        .withColumn(DELETED, F.lit(False))
        .unionByName(moved, allowMissingColumns=True)
    )


def landed_index(spark: SparkSession, root: str, runs: list[int] | None = None) -> DataFrame:
    """Index rows of some runs, or of all that the current objects are made of."""
    log = RunLog(spark, f"{root}/{RUNS}")
    runs = log.state() if runs is None else runs
    return read_state(spark, f"{root}/{INDEX}", log, OBJECT_INDEX, runs, "file_name")


def landed_history(spark: SparkSession, root: str, runs: list[int] | None = None) -> DataFrame:
    """Metadata rows of some runs, or of all that the current records are made of."""
    log = RunLog(spark, f"{root}/{RUNS}")
    runs = log.state() if runs is None else runs
    return read_records(spark, log, f"{root}/{METADATA}", LANDING, runs)


def append_index(rows: DataFrame, log: RunLog, root: str, run: int) -> None:
    columns = [F.col(f.name).cast(f.dataType) for f in OBJECT_INDEX]
    append_state(rows.select(*columns), f"{root}/{INDEX}", log, run, "file_name")


def read_records(
    spark: SparkSession, log: RunLog, root: str, schema: StructType, runs: list[int]
) -> DataFrame:
    """Metadata rows and marks of some runs; within a bucket they are sorted by month."""
    return read_state(spark, root, log, with_markers(schema), runs, "identifier", MONTH_FIRST)


def append_records(
    rows: DataFrame, log: RunLog, root: str, schema: StructType, run: int, more: bool = False
) -> None:
    """Metadata rows and marks of a run, in the order of the schema."""
    columns = [F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in with_markers(schema)]
    append_state(rows.select(*columns), root, log, run, "identifier", MONTH_FIRST, more)


def has_metadata(spark: SparkSession, root: str, run: int) -> bool:
    """Whether the metadata of a run is still there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{METADATA}/{BATCH}={run}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def landed_records(spark: SparkSession, root: str) -> DataFrame:
    """Current landing records of all months."""
    return current_rows(landed_history(spark, root), "identifier", *ARRIVAL).select(*LANDING_FIELDS)


def content_of(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Bytes of ``wanted(file_name, content_batch)``, from the batches that hold them only.

    Within those, files skip the row groups that have none of a few wanted names.
    """
    batches = [r[0] for r in wanted.select("content_batch").distinct().toLocalIterator()]
    content = read_batches(spark, f"{root}/{CONTENT}", OBJECT_CONTENT, sorted(batches))
    content = with_keys(content, "file_name", wanted)
    return pick_rows(content.withColumnRenamed(BATCH, "content_batch"), wanted, "file_name", "content_batch")


def rival_marks(mine: DataFrame, others: DataFrame) -> DataFrame:
    """Marks for records that two runs have put into different months without knowing of each other.

    The older version is marked with the order of the newer one, so a scan of its month finds
    that it has moved.
    """
    place = F.struct(*ARRIVAL, BATCH, "partition_date")
    a = mine.where(~F.col(DELETED)).select("identifier", place.alias("a"))
    b = others.where(~F.col(DELETED)).select("identifier", place.alias("b"))
    pairs = a.join(b, "identifier").where(~F.col("a.partition_date").eqNullSafe(F.col("b.partition_date")))
    pairs = pairs.select("identifier", F.least("a", "b").alias("old"), F.greatest("a", "b").alias("new"))
    return pairs.select(
        "identifier", "old.partition_date", *[F.col("new")[c].alias(c) for c in ARRIVAL],
        F.lit(True).alias(DELETED),
    )


def commit_run(
    spark: SparkSession, log: RunLog, number: int, seen: list[int], metadata: str, schema: StructType,
    tag: str = "",
) -> None:
    """Agree with runs that have become ready meanwhile, then commit.

    Whatever two runs do not know of each other, the one that is ready last adds its marks to its
    own batch, before it can be read.
    """
    log.ready(number)
    rivals = log.rivals(number, seen)
    if rivals:
        mine, others = (read_records(spark, log, metadata, schema, n) for n in ([number], rivals))
        # Written ahead, since the batch that is read is added to.
        work = Staging(spark, metadata)
        marks = work.table(rival_marks(mine, others), "marks")
        append_records(marks, log, metadata, schema, number, more=True)
        work.discard()
    log.commit(number, tag)


@dataclass(frozen=True)
class Landed:
    """What a landing run did: every item, the outcome per identifier, and numbers of items.

    The first two are tables of ``staging``; discard that when they are no longer read. The
    numbers were taken while the items were written.
    """

    batch: int
    items: DataFrame
    outcomes: DataFrame
    totals: dict[str, int]
    staging: Staging


class LandingRun:
    """One landing run below ``root``: it reads the state when it is made, writes, and is committed.

    Between these steps any other run may read, write, commit or compact.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = STATE_BUCKETS) -> None:
        self.spark, self.root = spark, root
        self.log = RunLog(spark, f"{root}/{RUNS}", buckets)
        self.batch = self.log.claim()
        self.seen = self.log.committed()
        self.index, self.history = landed_index(spark, root), landed_history(spark, root)

    def write(self, fetches: DataFrame) -> Landed:
        """Write all tables of the run; nothing of it is read before :meth:`commit`."""
        root, batch = self.root, self.batch
        work = Staging(self.spark, root)
        items, totals = work.counted(landing_items(fetches), "items", **item_totals())
        require_unique(items, "fetch_id")

        arrived = arrived_objects(items)
        stored = work.table(current_objects(stored_rows_of(self.index, arrived, "file_name")), "stored")
        newer = work.table(newer_objects(arrived, stored), "newer")
        wanted = work.table(changed_objects(newer, stored), "wanted")
        picked = pick_rows(fetches, wanted, "fetch_id")
        append_batch(object_content(picked), f"{root}/{CONTENT}", batch, key="file_name")
        append_index(index_changes(newer, wanted, stored, batch), self.log, root, batch)
        append_batch(rejected_items(items), f"{root}/{QUARANTINE}", batch)

        records = records_to_merge(items)
        known = stored_rows_of(self.history, records, "identifier")
        current = work.table(current_rows(known, "identifier", *ARRIVAL), "current")
        merged = work.table(
            upsert(current, records, "identifier", LANDING_FIELDS, keep_untouched=False, order=ARRIVAL),
            "merged",
        )
        changes = metadata_changes(merged, current, ARRIVAL)
        append_records(changes, self.log, f"{root}/{METADATA}", LANDING, batch)
        return Landed(batch, items, merged.select("identifier", "outcome"), totals, work)

    def commit(self, tag: str = "") -> None:
        metadata = f"{self.root}/{METADATA}"
        commit_run(self.spark, self.log, self.batch, self.seen, metadata, LANDING, tag)


def land(
    spark: SparkSession, fetches: DataFrame, root: str, tag: str = "", buckets: int = STATE_BUCKETS
) -> Landed:
    """Land fetched documents below ``root``, as one run.

    All tables of the run become visible together, by its commit. Of several fetches of
    one identifier or object the last by ``ARRIVAL`` counts, also against what other runs have
    stored: a late one loses. ``fetch_id`` must be unique. ``tag`` names what is landed. State is
    written in ``buckets`` of its keys: what comes in is brought to the state, never the other way.
    """
    run = LandingRun(spark, root, buckets)
    landed = run.write(fetches)
    run.commit(tag)
    return landed


def compact(
    spark: SparkSession, root: str, move_content: bool = False, buckets: int = STATE_BUCKETS
) -> int:
    """Write the current rows of the landing zone as one run that replaces those it has read.

    The index says where the bytes of each object are, so content stays where it is. With
    ``move_content`` the current bytes are copied as well, and no earlier batch is needed any
    more. Others may land meanwhile: runs that are not among those read stay visible. While a run
    is open, marks of moved records are kept for what it may bring.
    """
    log = RunLog(spark, f"{root}/{RUNS}", buckets)
    batch = log.claim()
    seen, replaced = log.committed(), log.state()
    # What was open when the state was read is open still, or committed since.
    others = set(log.open_runs()) | set(log.committed())
    others -= {batch, *seen}
    history = landed_history(spark, root, replaced)
    objects = current_objects(landed_index(spark, root, replaced)).drop(BATCH)
    records = current_rows(history, "identifier", *ARRIVAL).withColumn(DELETED, F.lit(False))
    if others:
        marks = history.where(DELETED).groupBy("identifier", "partition_date").agg(
            F.max(F.struct(*ARRIVAL)).alias("last")
        )
        marks = marks.select("identifier", "partition_date", "last.*", F.lit(True).alias(DELETED))
        records = records.unionByName(marks, allowMissingColumns=True)
    work = Staging(spark, root)
    objects = work.table(objects, "objects")
    if move_content:
        moved = content_of(spark, root, objects.select("file_name", "content_batch"))
        append_batch(moved.select("file_name", "content"), f"{root}/{CONTENT}", batch, key="file_name")
        objects = objects.withColumn("content_batch", F.lit(batch))
    append_index(objects, log, root, batch)
    append_records(records, log, f"{root}/{METADATA}", LANDING, batch)
    log.commit(batch, replaces=replaced)
    work.discard()
    return batch


def remove_superseded(spark: SparkSession, root: str, give_up: bool = False) -> list[int]:
    """Delete content batches that no current object is in, and state that bases have replaced.

    For times when nothing reads. An open run may still point to old content, so nothing is deleted
    while there is one; with ``give_up`` open runs (lost ones) are ended first and can no longer
    be committed. Returns the content batches that are gone.
    """
    log = RunLog(spark, f"{root}/{RUNS}")
    for n in log.open_runs():
        if not give_up:
            return []
        log.give_up(n)
    state = set(log.state())
    needed = current_objects(landed_index(spark, root)).select("content_batch").distinct()
    needed = {r[0] for r in needed.toLocalIterator()}
    old = [n for n in log.committed() if n not in state]
    gone = [n for n in log.committed() if n not in needed]
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for table, batches in ((INDEX, old), (METADATA, old), (CONTENT, gone)):
        for n in batches:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/{BATCH}={n}"), True)
    return gone
