"""Change detection, keyed upsert and incremental work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.sources.tables import with_keys

INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


def month_range_scan(
    df: DataFrame,
    start: str,
    end: str,
    partition: str = "partition_date",
    day: str | None = None,
) -> DataFrame:
    """Rows of the months of ``start`` to ``end``, both included, compared as text.

    On a table partitioned by month only the files of those months are read. Where
    the month is computed, ``day`` names the date behind it, and the same range on the
    date is pushed down to the files.
    """
    rows = df.where(F.col(partition).between(start[:7], end[:7]))
    if day is None:
        return rows
    first, last = (F.lit(f"{d[:7]}-01").cast("date") for d in (start, end))
    of_column = df.schema[day].dataType
    return rows.where(
        (F.col(day) >= first.cast(of_column))
        & (F.col(day) < F.add_months(last, 1).cast(of_column))
    )


def last_arrival(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the last one by ``order``, other columns breaking ties.

    The maximum of whole rows is an aggregate: each task first keeps one row per key.
    """
    columns = [*order, *[c for c in df.columns if c != key and c not in order]]
    rows = df.groupBy(key).agg(F.max(F.struct(*columns)).alias("__row"))
    return rows.select(*[c if c == key else F.col("__row")[c].alias(c) for c in df.columns])


def changed_objects(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Objects that are new or whose hash differs from the stored one.

    ``stored`` has one row per object. Joining by name alone keeps the partitioning
    that the aggregates before it have made.
    """
    known = stored.select("file_name", F.coalesce("file_hash", F.lit("")).alias("__stored"))
    new = F.col("__stored").isNull()
    changed = new | ~F.col("file_hash").eqNullSafe(F.col("__stored"))
    return incoming.join(known, "file_name", "left").where(changed).drop("__stored")


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    key: str,
    fields: Sequence[str],
    keep_untouched: bool = True,
    order: Sequence[str] = (),
) -> DataFrame:
    """Merge one incoming row per key; ``fields`` win, other stored fields stay.

    ``outcome`` is inserted, updated, unchanged or, for stored rows without an
    incoming one, kept. Without ``keep_untouched`` those rows are left out and only
    stored rows with an incoming key take part. With ``order``, columns of both sides, a
    stored row that comes later than the incoming one is kept as it is; else the order of
    the incoming row is taken over, also where its fields are unchanged.
    """
    taken = [*fields, *order]
    extra = [c for c in stored.columns if c != key and c not in taken]
    old = stored.select(
        key, F.struct(*taken).alias("__old"), *extra, F.lit(True).alias("__stored")
    )
    new = incoming.select(key, F.struct(*taken).alias("__new"), F.lit(True).alias("__arrived"))
    if keep_untouched:
        joined = old.join(new, key, "full")
    else:
        joined = new.join(old, key, "left")
    known = F.col("__stored").isNotNull()
    arrived = F.col("__arrived").isNotNull()
    if order:
        late = F.struct(*[F.col("__old")[c] for c in order]) > F.struct(
            *[F.col("__new")[c] for c in order]
        )
        arrived = arrived & ~F.coalesce(known & late, F.lit(False))

    def picked(side: str) -> Column:
        return F.struct(*[F.col(side)[f] for f in fields])

    outcome = (
        F.when(~arrived, KEPT)
        .when(~known, INSERTED)
        .when(picked("__old").eqNullSafe(picked("__new")), UNCHANGED)
        .otherwise(UPDATED)
    )
    merged = [
        F.when(arrived, F.col("__new")[f]).otherwise(F.col("__old")[f]).alias(f)
        for f in taken
        if f != key
    ]
    return joined.select(key, *merged, *extra, outcome.alias("outcome"))


def stored_rows_of(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Stored rows with an incoming key, so that only those are shuffled further.

    On tables bucketed by the key only the incoming keys are moved, and of a few keys only the
    buckets and row groups are opened that may have them.
    """
    stored = with_keys(stored, key, incoming)
    return stored.join(incoming.select(key).distinct(), key, "left_semi")


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that break uniqueness, with their number of rows; empty when all is well."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def pending_transform(landed: DataFrame, transformed: DataFrame) -> DataFrame:
    """Landed records not yet transformed from their present hash.

    Two missing hashes are equal. Only keys and hashes take part, never content.
    """
    done = transformed.select("identifier", "source_hash")
    same = (landed["identifier"] == done["identifier"]) & landed["file_hash"].eqNullSafe(
        done["source_hash"]
    )
    return landed.join(done, same, "left_anti")


def missing_objects(records: DataFrame, index: DataFrame, *key: str) -> DataFrame:
    """Records without an object, found on the narrow index; content is not touched."""
    return records.join(index.select(*key).distinct(), list(key), "left_anti")


def pick_rows(wide: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """The rows of a table with content that a narrow list of keys names.

    A semi-join in every case. Below the session's broadcast threshold, which Spark
    compares with the size of the written list, no content is shuffled.
    """
    return wide.join(wanted.select(*key), list(key), "left_semi")


def require_unique(df: DataFrame, *key: str) -> None:
    """Fail with an example if a key is null or occurs twice."""
    bad = duplicate_keys(df, *key).select(*key).unionByName(
        df.select(*key).where(" OR ".join(f"{k} IS NULL" for k in key))
    ).first()
    if bad is not None:
        raise ValueError(f"{', '.join(key)} must be unique and not null: {tuple(bad)}")
