"""Exact dedup: a tree-merge of sorted digest runs.

Every document becomes a narrow entry (digest of its normalised text, identifier). The
entries are dealt over *slots*; within a slot equal digests are folded into one entry,
sorted: a run. Runs are then exchanged in binomial rounds: in round ``k`` a slot meets the
slots that differ from it in digit ``k`` only, each entry goes to the one of them whose
digit the digest names, and the receiver merges the sorted runs, keeping the identifier
that stays. After the last round equal digests have met, and every slot holds its own
range of digests, so no task ever holds all of them. Entries count as equal only if a
second hash and the length agree with the digest (verified at every level).

Answers go back to the runs of the first level, where a digest has one entry per slot,
and from there to the documents of that slot, so a text that a third of all rows share
is spread over all slots in every join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import ascii_lower, free_name, handing_back, shuffle_parts, stage_for

FAN_IN = 4
SAME = ["digest", "check", "bytes"]
RUN = "slot long, digest binary, check long, bytes long, keep_id long, members long"


def _boundaries(columns: list[np.ndarray]) -> np.ndarray:
    """Places where a new group of equal entries starts, in sorted columns."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _fold(batches: Iterator[pa.RecordBatch], largest: bool) -> Iterator[pa.RecordBatch]:
    """Merge sorted runs: neighbours that are equal in all of ``SAME`` become one entry.

    The last group of a batch is held back, since the next batch may go on with it.
    """
    schema, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        schema = batch.schema
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        digest = np.frombuffer(
            b"".join(table["digest"].to_pylist()), dtype="V32"
        ) if table.num_rows else np.empty(0, "V32")
        keys = [table[c].to_numpy() for c in ("slot", "check", "bytes")]
        starts = _boundaries([*keys, digest])
        keep = table["keep_id"].combine_chunks()
        known = keep.is_valid().to_numpy(zero_copy_only=False)
        worst = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max
        ids = np.where(known, keep.fill_null(0).to_numpy(zero_copy_only=False), worst)
        best = (np.maximum if largest else np.minimum).reduceat(ids, starts)
        some = np.logical_or.reduceat(known, starts)
        members = np.add.reduceat(table["members"].to_numpy(), starts)
        folded = table.take(pa.array(starts)).set_column(
            table.schema.get_field_index("keep_id"), schema.field("keep_id"),
            pa.array(best, pa.int64(), mask=~some),
        ).set_column(
            table.schema.get_field_index("members"), schema.field("members"), pa.array(members)
        ).combine_chunks()
        whole = folded.to_batches()[0]
        held = whole.slice(whole.num_rows - 1)
        if whole.num_rows > 1:
            yield whole.slice(0, whole.num_rows - 1)
    if held is not None:
        yield held


def _merged(entries: DataFrame, slots: int, largest: bool) -> DataFrame:
    """One sorted run per slot, from entries that already name the slot they go to."""
    runs = entries.repartition(slots, "slot").sortWithinPartitions("slot", *SAME)
    return runs.mapInArrow(handing_back(lambda batches: _fold(batches, largest)), RUN)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, check, bytes`` of every row: SHA-256, xxHash64 and length."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    row = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("__text"))
    return row.select(
        "doc_id",
        F.unhex(F.sha2("__text", 256)).alias("digest"),
        F.xxhash64("__text").alias("check"),
        F.octet_length("__text").cast("long").alias("bytes"),
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Per row ``doc_id, digest, keep_id, group_size``.

    Texts are equal when identical after lowering A-Z only; null counts as empty text.
    ``keep`` says which identifier of equal texts stays. A null identifier is never kept
    while the group has another; in a group of nulls only ``keep_id`` is null. Repeated
    rows are members of their own and count in ``group_size``. An empty table gives an
    empty result; other columns of ``docs`` are not looked at.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    spark = docs.sparkSession
    staging, largest = stage_for(spark), keep == "largest"
    rounds = 1
    while fan_in**rounds < shuffle_parts(spark):
        rounds += 1
    slots = fan_in**rounds
    home = F.pmod(F.xxhash64("doc_id", "check"), F.lit(slots))
    rows = digests(docs, id_col, text_col).withColumn("slot", home)
    rows = staging.table(rows, "rows")

    level = _merged(
        rows.select(
            "slot", *SAME, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("members")
        ),
        slots, largest,
    )
    first = staging.table(level, "level-0")
    runs = first
    # The digits of a digest, read as one number below ``slots``.
    own = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long"), F.lit(slots))
    for k in range(rounds):
        unit = fan_in**k
        here = F.pmod(F.floor(F.col("slot") / unit), F.lit(fan_in))
        there = F.pmod(F.floor(own / unit), F.lit(fan_in))
        sent = runs.withColumn("slot", (F.col("slot") + (there - here) * unit).cast("long"))
        runs = staging.table(_merged(sent, slots, largest), f"level-{k + 1}")

    answers = runs.select(*SAME, "keep_id", F.col("members").alias("group_size"))
    by_slot = first.select("slot", *SAME).join(answers, SAME)
    return rows.join(by_slot, ["slot", *SAME]).select("doc_id", *SAME, "keep_id", "group_size")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the largest identifier.

    All columns stay as they are. Of repeated rows (same identifier, same text) one stays.
    """
    groups = exact_groups(docs, id_col, text_col, keep="largest")
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = kept.groupBy("doc_id", *SAME).agg(F.count("*").alias("__n"))
    kept = stage_for(docs.sparkSession).table(kept, "kept")
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    own = free_name(docs, "__digest")
    left = docs.withColumn(own, F.unhex(F.sha2(text, 256))).alias("l")
    found = F.col(f"l.{id_col}").eqNullSafe(F.col("r.doc_id")) & (
        F.col(f"l.{own}") == F.col("r.digest")
    )
    rows = left.join(kept.alias("r"), found, "left_semi")
    if not kept.where("__n > 1").isEmpty():
        rows = rows.dropDuplicates([id_col, own])
    return rows.drop(own)
