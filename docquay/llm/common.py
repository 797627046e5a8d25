"""Helpers shared by the operators: text columns, staged tables, Arrow words, running sums."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docquay.sources.staging import Staging

#: Text that a task looks at in one go; only bounds memory, results do not depend on it.
SLICE_BYTES = 4 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII text takes the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_for(spark: SparkSession) -> Staging:
    """A new folder for written intermediate tables, in the session's shared folder."""
    return Staging(spark)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_sum(
    df: DataFrame, group: list[str], coarse: str, order: list[str], value: str, out: str
) -> DataFrame:
    """Sum of ``value`` over the rows of ``group`` that come before, in ``out``.

    ``coarse`` is a non-null number that does not decrease along ``order``. Rows are
    ordered within (group, coarse) only, and the totals of those parts are summed
    ahead, so a group that holds most rows is spread over as many tasks as it has parts.
    """
    parts = df.groupBy(*group, coarse).agg(F.sum(value).alias("__part"))
    ahead = W.partitionBy(*group).orderBy(coarse).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("__ahead", F.coalesce(F.sum("__part").over(ahead), F.lit(0)))
    left, right = df.alias("l"), parts.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*group, coarse]]
    within = W.partitionBy(*group, coarse).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    joined = left.join(right, same).select("l.*", "r.__ahead")
    mine = F.coalesce(F.sum(value).over(within), F.lit(0))
    return joined.withColumn(out, F.col("__ahead") + mine).drop("__ahead")


def slices(
    batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def rows_at_once(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of so many rows, for work that turns them into Python objects."""
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def handing_back(run: Callable) -> Callable:
    """``run`` over batches; when a task ends, its worker gives freed memory back to the machine.

    Workers are kept for later tasks, and what one has once needed would stay with it.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
            ctypes.CDLL(None).malloc_trim(0)

    return task


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space, A-Z lowered: row of each word, and the words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    return rows[full.to_numpy(zero_copy_only=False)], flat.filter(full)


def row_hash(text: Column) -> Column:
    """Tells rows apart that share an identifier."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(
    docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs`` that ``kept(doc_id, row_hash)`` names, one for each of its rows' keys.

    ``kept`` must be a written table. If it names a key twice, ``docs`` has repeated rows,
    and one of them stays; all columns stay as they are.
    """
    keys = kept.groupBy("doc_id", "row_hash").agg(F.count("*").alias("__n"))
    own = free_name(docs, "__hash")
    left = docs.withColumn(own, row_hash(F.col(text_col))).alias("l")
    same = F.col(f"l.{id_col}").eqNullSafe(F.col("r.doc_id")) & (
        F.col(f"l.{own}") == F.col("r.row_hash")
    )
    rows = left.join(keys.alias("r"), same, "left_semi")
    if not keys.where("__n > 1").isEmpty():
        rows = rows.dropDuplicates([id_col, own])
    return rows.drop(own)


def fold(id_col: str, folds: int) -> Column:
    """CRC-32 of the identifier as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


#: Cells of the bit table that thins out rows before a join: 2^18 rows of 64.
CELLS = 1 << 24


def thinned(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key``, a hash, may be among those of ``wanted``: all that are, and few others.

    The bit table has at most ``CELLS / 64`` rows whatever the input, so it may be broadcast.
    """
    cell = F.pmod(F.col(key), F.lit(CELLS))
    table = wanted.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("__mask")
    )
    found = rows.withColumn("__word", F.shiftright(cell, 6)).join(F.broadcast(table), "__word")
    bit = F.expr(f"getbit(__mask, cast(pmod({key}, {CELLS}) & 63 as int))")
    return found.where(bit == 1).drop("__word", "__mask")
