"""Tables in parquet: plain inputs, and append-only tables of numbered batches.

All tables of a zone are written by *runs*. A run claims a number that no other run can
get, writes one batch of that number into each of its tables, and is committed last, by
one file for all of them. Readers only see batches of committed runs, so a run that is
lost half-way leaves nothing behind that anyone reads, and nothing is ever overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

BATCH = "batch"
#: Files that a batch of a state table is cut into by its key. A zone of any size works with any number;
#: about a gigabyte of state per bucket is a good one.
STATE_BUCKETS = 16
DELETED = "deleted"


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan for CPU-heavy work: enough tasks for all cores.

    A single file of one row group is one task however it is split, so an input with fewer
    splits than cores is redistributed; large inputs have many splits and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class RunLog:
    """Claims and commits of the runs of a zone, as empty files below ``folder``.

    A file is created exclusively, which file systems do atomically: two writers never
    hold the same number. A run claims its number before it reads, says when it is ready, and is
    committed last. A commit may name a ``tag`` (what it has processed) and the runs that it
    *replaces*: its tables hold their current rows. Every other committed run is read, whenever it
    was claimed or committed, so writers and compactions never wait for each other.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = STATE_BUCKETS) -> None:
        self.folder, self.buckets = folder, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> list[str]:
        found = self._files.globStatus(self._path(f"{self.folder}/{kind}/*")) or []
        return sorted(f.getPath().getName() for f in found)

    def _numbers(self, kind: str) -> list[int]:
        return [int(n) for n in self._names(kind)]

    def _create(self, kind: str, name: str) -> bool:
        self._files.mkdirs(self._path(f"{self.folder}/{kind}"))
        try:
            return self._files.createNewFile(self._path(f"{self.folder}/{kind}/{name}"))
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise

    def claim(self) -> int:
        """A number above all others, for this run alone."""
        number = max(self._numbers("claimed"), default=-1) + 1
        while not self._create("claimed", f"{number:010d}"):
            number += 1
        return number

    def ready(self, number: int) -> None:
        """All batches of the run are written; others may read them, to agree with it."""
        self._create("ready", f"{number:010d}")

    def rivals(self, number: int, seen: Iterable[int]) -> list[int]:
        """Other runs that are or may become visible, and that were not when this one read.

        Of two runs that do not know of each other, the one that is ready last finds the other. What
        replaces other runs brings nothing of its own and is not among them.
        """
        waiting = set(self._numbers("ready")) - set(self._numbers("ended"))
        unseen = (set(self.committed()) | waiting) - set(seen) - {number}
        return sorted(n for n in unseen if not self.noted(n, "replaces"))

    def commit(self, number: int, tag: str = "", replaces: Iterable[int] = ()) -> None:
        """Make the batches of the run visible, all at once; a number is committed once."""
        self.note(number, "replaces", replaces)
        if not self._create("ended", f"{number:010d}"):
            raise ValueError(f"run {number} is committed or given up already")
        kind = "base" if self.noted(number, "replaces") else "run"
        self._create("committed", f"{number:010d}.{kind}.{tag}")

    def give_up(self, number: int) -> bool:
        """End a run that is lost; it can no longer be committed. False if it has ended already."""
        return self._create("ended", f"{number:010d}")

    def open_runs(self) -> list[int]:
        """Runs that are neither committed nor given up."""
        return sorted(set(self._numbers("claimed")) - set(self._numbers("ended")))

    def note(self, number: int, kind: str, runs: Iterable[int]) -> None:
        """Keep numbers of other runs with this one, before it is committed."""
        for n in runs:
            self._create(f"{kind}/{number:010d}", f"{n:010d}")

    def noted(self, number: int, kind: str) -> list[int]:
        return self._numbers(f"{kind}/{number:010d}")

    def _commits(self) -> list[tuple[int, str, str]]:
        parts = (n.split(".", 2) for n in self._names("committed"))
        return [(int(number), kind, tag) for number, kind, tag in parts]

    def has(self, tag: str) -> bool:
        return any(found == tag for _, _, found in self._commits())

    def committed(self) -> list[int]:
        return [number for number, _, _ in self._commits()]

    def bases(self) -> dict[int, list[int]]:
        """Committed runs that replace others, with what they replace."""
        return {n: self.noted(n, "replaces") for n, kind, _ in self._commits() if kind == "base"}

    def state(self) -> list[int]:
        """Committed runs that no committed base replaces: what the current rows are made of."""
        replaced = {n for runs in self.bases().values() for n in runs}
        return [n for n in self.committed() if n not in replaced]


def append_batch(
    df: DataFrame, root: str, batch: int, partition_by: str | None = None, more: bool = False,
    key: str | None = None,
) -> None:
    """Write one batch; even file sizes, also when one partition holds most rows.

    It becomes visible when its run is committed. Writing to a batch that exists fails, unless
    ``more`` rows are added before that. With a ``key`` every file is sorted by it and has bloom
    filters of it, sized by what is in them, so :func:`with_keys` finds few keys without reading all.
    """
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    if key is not None:
        df = df.sortWithinPartitions(key)
    writer = df.write.mode("append" if more else "error")
    if key is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{root}/{BATCH}={batch}")


def read_batches(
    spark: SparkSession, root: str, schema: StructType, batches: Iterable[int]
) -> DataFrame:
    """The rows of some batches, with their number in ``batch``; other folders are not listed."""
    schema = StructType([f for f in schema if f.name != BATCH] + [StructField(BATCH, IntegerType())])
    paths = [f"{root}/{BATCH}={n}" for n in batches]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _defined(spark: SparkSession, path: str, schema: StructType, key: str, sort: list[str], buckets: int) -> str:
    """Name of a table over files that are there; whoever defines it drops the name, the files stay."""
    name = f"docquay_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`)"
        f" SORTED BY ({', '.join(f'`{c}`' for c in sort)}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return name


def append_state(
    df: DataFrame, root: str, log: RunLog, batch: int, key: str, sort: tuple[str, ...] = (),
    more: bool = False,
) -> None:
    """Write one batch of a state table: bucketed by ``key``, each bucket sorted by ``sort`` and key.

    How many buckets it has is kept with the run, before anything is written. Files have bloom
    filters of the key, and ranges of what they are sorted by. Writing to a batch that exists
    fails, unless ``more`` rows are added before the run is committed.
    """
    spark, path, order = df.sparkSession, f"{root}/{BATCH}={batch}", [*sort, key]
    log.note(batch, "buckets", [log.buckets])
    df = df.repartition(log.buckets, key)
    if more:
        name = _defined(spark, path, df.schema, key, order, log.buckets)
        writer = df.write.mode("append").insertInto
    else:
        name = f"docquay_{uuid.uuid4().hex}"
        writer = (
            df.write.format("parquet").bucketBy(log.buckets, key).sortBy(*order).option("path", path)
            .option(f"parquet.bloom.filter.enabled#{key}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
        ).saveAsTable
    try:
        writer(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_state(
    spark: SparkSession, root: str, log: RunLog, schema: StructType, batches: Iterable[int], key: str,
    sort: tuple[str, ...] = (),
) -> DataFrame:
    """The rows of some batches of a state table, with their number in ``batch``.

    Every batch is a scan by buckets, so a join with keys moves those keys and no state. Batches
    that were not written by :func:`append_state` are read as plain files.
    """
    schema = StructType([f for f in schema if f.name != BATCH])
    plain, parts = [], []
    for n in batches:
        buckets = log.noted(n, "buckets")
        if not buckets:
            plain.append(n)
            continue
        name = _defined(spark, f"{root}/{BATCH}={n}", schema, key, [*sort, key], buckets[0])
        parts.append(spark.table(name).withColumn(BATCH, F.lit(n)))
        spark.sql(f"DROP TABLE {name}")
    if plain or not parts:
        parts.append(read_batches(spark, root, schema, plain))
    return reduce(DataFrame.unionByName, parts)


#: As many keys as a scan is told one by one; more are joined without.
KEYS_TOLD = 256


def with_keys(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` that may have one of the keys of ``wanted``; for a join that follows.

    Few keys become a condition of the scan: it skips row groups whose range or bloom filter has
    none of them, and pages besides. With many keys all rows are left to the join.
    """
    keys = [r[0] for r in wanted.select(key).distinct().limit(KEYS_TOLD + 1).collect()]
    if len(keys) > KEYS_TOLD:
        return df

    def any_of(part: list[str]) -> Column:
        half = len(part) // 2
        return any_of(part[:half]) | any_of(part[half:]) if half else F.col(key) == part[0]

    return df.where(any_of(keys) if keys else F.lit(False))


def latest_rows(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the greatest by ``order``.

    An aggregate, so each task first keeps one row per key and a hot key costs one
    row per task in the shuffle, where a window would sort all its rows in one task.
    """
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("__row")).select(key, "__row.*")


def current_rows(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Current row per key of a batch table, without keys that were moved away.

    The last one by ``order``, then by batch. A mark that says a row has moved to another
    place loses against that row, and wins against what it marks. Where there is an order, a mark has
    that of the row moved, whichever run has written it.
    """
    ties = [~F.col(DELETED), F.col(BATCH)] if order else [F.col(BATCH), ~F.col(DELETED)]
    live = latest_rows(df, key, *[F.col(c) for c in order], *ties)
    return live.where(~F.col(DELETED)).drop(BATCH, DELETED)


def with_markers(schema: StructType) -> StructType:
    return StructType(list(schema) + [StructField(DELETED, BooleanType())])


def read_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as objects: name, bytes and time, from any Hadoop file system."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.substring_index("path", "/", -1).alias("file_name"),
        "content",
        F.col("modificationTime").alias("fetched_at"),
    )
