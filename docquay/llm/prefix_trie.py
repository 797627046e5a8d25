"""Prefix trie of conversations, with totals of every subtree by time-forward processing.

A node is a sequence of first turns. Its key is a depth and 128 bits: the exclusive or of two
hashes of each turn at its place, a running aggregate that long conversations are cut for.
Totals travel from the deepest level up: nodes are sorted by falling depth, and a node's
totals wait for its parent in a priority queue that spills to sorted files.

The trie is cut into pieces. A piece begins at every ``LEVELS``-th depth, and where a path
leaves the heavy nodes, those that more than the root of the number of conversations share.
So no piece has more than that root of paths, and a level no more than that root of heavy
nodes. Pieces are spread over shards and give the totals of their roots; a second pass carries
those across the roots of pieces that have others below them; a third one gives every node
its totals.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docquay.llm.common import running_sum, shuffle_parts, stage_for
from docquay.sources.staging import Staging

LEVELS = 1024
#: Rows that a heavy node's key is spread over in joins.
SALTS = 32
#: Conversation identifiers that are put together before a node's list of them is hashed.
IDS_BITS = 12
#: Totals that wait in memory before they are written to a sorted file.
WAITING = 200_000
ROWS_OUT = 4096

KEY = ("depth", "a", "b")
#: Turns ordered together when places are counted; only spreads long conversations.
TURNS_PER_PART = 512


def placed_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` in order of ``turn`` (null first), then role and text; from 0."""
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.lit(1).cast("long").alias("one"),
    )
    part = F.coalesce(F.floor(F.col("turn") / TURNS_PER_PART), F.lit(-(1 << 62))).cast("long")
    rows = running_sum(rows.withColumn("part", part), ["conv_id"], "part", ["turn", "role", "text"], "one", "place")
    return rows.select("conv_id", "place", "role", "text")


def key_bits(*more: Column) -> list[Column]:
    """Two 64-bit hashes of a turn at its place."""
    return [F.xxhash64(F.lit(salt), *more).alias(name) for salt, name in ((11, "ha"), (29, "hb"))]


def _running_xor(turns: DataFrame) -> DataFrame:
    """``a, b`` up to and with each turn, ``pa, pb`` before it, and ``length`` of the conversation.

    Blocks of ``LEVELS`` turns are put together first, so no conversation is sorted in one task.
    """
    rows = turns.withColumn("block", F.floor(F.col("depth") / LEVELS).cast("long"))
    parts = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("ha").alias("xa"), F.bit_xor("hb").alias("xb"), F.max("depth").alias("last")
    )
    ahead = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = parts.select(
        "conv_id", "block",
        F.coalesce(F.bit_xor("xa").over(ahead), zero).alias("xa"),
        F.coalesce(F.bit_xor("xb").over(ahead), zero).alias("xb"),
        F.max("last").over(W.partitionBy("conv_id")).alias("length"),
    )
    within = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"ra": F.bit_xor("ha").over(within), "rb": F.bit_xor("hb").over(within)})
    rows = rows.join(parts, ["conv_id", "block"]).withColumns(
        {"a": F.col("ra").bitwiseXOR(F.col("xa")), "b": F.col("rb").bitwiseXOR(F.col("xb"))}
    )
    return rows.withColumns(
        {"pa": F.col("a").bitwiseXOR(F.col("ha")), "pb": F.col("b").bitwiseXOR(F.col("hb"))}
    ).drop("xa", "xb", "ra", "rb", "ha", "hb")


def trie_paths(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conversation and depth, from the root (0) on: keys of the node and its parent.

    ``conversations`` has ``conv_id``, ``turns`` ``conv_id, depth, role, text`` with depths from 1.
    Columns: ``conv_id, length, depth, a, b, pa, pb, block, check1, check2, words``.
    """
    ha, hb = key_bits("depth", "role", "text")
    told = F.concat_ws(" ", F.octet_length("role").cast("string"), "role", "text")
    turns = turns.withColumn("__sha", F.sha2(F.encode(told, "utf-8"), 256))
    checks = [F.conv(F.substring("__sha", at, 15), 16, 10).cast("long").alias(name)
              for at, name in ((1, "check1"), (16, "check2"))]
    narrow = turns.select(
        "conv_id", "depth", ha, hb, *checks,
        F.size(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).cast("long").alias("words"),
    )
    root = conversations.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("ha"),
        F.lit(0).cast("long").alias("hb"), F.lit(0).cast("long").alias("check1"),
        F.lit(0).cast("long").alias("check2"), F.lit(0).cast("long").alias("words"),
    )
    return _running_xor(narrow.unionByName(root))


def _nodes(paths: DataFrame) -> DataFrame:
    """One row per node; fails if two sequences of turns ever got one key.

    All members of a node have the same last turn and, by their keys, the same parent; so from
    the root down the sequences are the same.
    """
    same = F.lit(True)
    for c in ("check1", "check2", "pa", "pb"):
        same = same & (F.min(c) == F.max(c))
    broken = F.raise_error(F.lit("two sequences of turns have one key")).cast("long")
    return paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.max("words").alias("words"),
        (F.max("length") == F.col("depth")).alias("leaf"), same.alias("same"),
    ).withColumn("n_convs", F.when(F.col("same"), F.col("n_convs")).otherwise(broken)).drop("same")


def _salt(bits: str) -> Column:
    return 1 + F.pmod(F.xxhash64(bits), F.lit(SALTS))


def _salted(heavy: DataFrame) -> DataFrame:
    return heavy.withColumn("salt", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(SALTS).cast("long"))))


def _pieces(paths: DataFrame, nodes: DataFrame, staging: Staging, over: int) -> DataFrame:
    """``nodes`` with the key of the root of their piece (``rd, ra, rb``) and their parent's ``conv_id``.

    Nodes of more than ``over`` conversations are heavy. Joins with these are salted; all others
    have at most ``over`` rows of a key.
    """
    heavy = staging.table(nodes.where(F.col("n_convs") > over).select(*KEY, "conv_id"), "heavy")
    below = paths.select("conv_id", "block", *KEY, _salt("conv_id").alias("salt"))
    shared = below.join(_salted(heavy.select(*KEY)), [*KEY, "salt"], "left_semi")
    shared = shared.groupBy("conv_id", "block").agg(F.max("depth").alias("heavy_to"))
    rows = paths.select("conv_id", "block", *KEY).join(shared, ["conv_id", "block"], "left")
    rows = rows.withColumn("heavy_to", F.coalesce("heavy_to", F.lit(-1)).cast("long"))
    begin = F.col("block") * LEVELS
    rows = rows.withColumn(
        "rd", F.when(F.col("depth") <= F.col("heavy_to"), begin)
        .otherwise(F.greatest(begin, F.col("heavy_to") + 1))
    )
    # The root of a piece is a node of the same path, in the same block.
    path = W.partitionBy("conv_id", "block")
    is_begin, is_light = F.col("depth") == begin, F.col("depth") == F.greatest(begin, F.col("heavy_to") + 1)
    for bits in ("a", "b"):
        rows = rows.withColumn(f"begin_{bits}", F.max(F.when(is_begin, F.col(bits))).over(path))
        rows = rows.withColumn(f"light_{bits}", F.max(F.when(is_light, F.col(bits))).over(path))
    at_begin = F.col("rd") == begin
    rows = rows.select(
        "conv_id", *KEY, "heavy_to", "rd",
        *[F.when(at_begin, F.col(f"begin_{c}")).otherwise(F.col(f"light_{c}")).alias(f"r{c}") for c in "ab"],
    )
    # Each node from the path of the smallest conversation that has it.
    rows = nodes.join(rows, ["conv_id", *KEY])
    parents = nodes.select(*KEY, "conv_id", F.lit(0).cast("long").alias("salt")).unionByName(_salted(heavy))
    parents = parents.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), "salt",
        F.col("conv_id").alias("parent_conv_id"),
    )
    has_heavy = F.col("depth") - 1 <= F.col("heavy_to")
    rows = rows.withColumn("salt", F.when(has_heavy, _salt("a")).otherwise(F.lit(0)).cast("long"))
    return rows.join(parents, ["depth", "pa", "pb", "salt"], "left").drop("salt", "heavy_to")


class WaitingTotals:
    """Priority queue of totals for nodes yet to come, by falling depth, then key.

    Totals for one node are added up as they come. What does not fit into ``limit`` entries is
    written to a sorted file of the task, which goes with it; files are read in blocks.
    """

    FIELDS = 6  # minus depth, a, b, children, leaves, saved

    def __init__(self, limit: int = WAITING) -> None:
        self.limit, self.heap, self.sums = limit, [], {}
        self.files: list = []
        self.heads: list[tuple] = []

    def put(self, key: tuple[int, int, int], totals: tuple[int, int, int]) -> None:
        old = self.sums.get(key)
        if old is None:
            heapq.heappush(self.heap, key)
            self.sums[key] = totals
            if len(self.heap) > self.limit:
                self._spill()
        else:
            self.sums[key] = tuple(x + y for x, y in zip(old, totals))

    def _spill(self) -> None:
        rows = np.array([(*k, *self.sums[k]) for k in sorted(self.heap)], dtype=np.int64)
        file = tempfile.TemporaryFile()
        file.write(rows.tobytes())
        file.seek(0)
        self.files.append(self._read(file))
        self.heap, self.sums = [], {}
        self._next(len(self.files) - 1)

    def _read(self, file) -> Iterator[tuple]:
        width = self.FIELDS * 8
        with file:
            while block := file.read(ROWS_OUT * width):
                yield from map(tuple, np.frombuffer(block, np.int64).reshape(-1, self.FIELDS).tolist())

    def _next(self, k: int) -> None:
        row = next(self.files[k], None)
        if row is not None:
            heapq.heappush(self.heads, (row[:3], k, row[3:]))

    def take(self, key: tuple[int, int, int]) -> tuple[int, int, int]:
        """All totals for ``key``, the least key that is still to come."""
        total = (0, 0, 0)
        if self.heap and self.heap[0] == key:
            total = self.sums.pop(heapq.heappop(self.heap))
        while self.heads and self.heads[0][0] == key:
            _, k, more = heapq.heappop(self.heads)
            total = tuple(x + y for x, y in zip(total, more))
            self._next(k)
        return total


def _forward(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple]:
    """Totals of the nodes of a shard, deepest first; totals from other pieces come as rows before them.

    Rows are ``depth, a, b, pa, pb, inside, own leaves, own saved, given children``: a row that is
    ``given`` only adds to what waits for its node.
    """
    queue = WaitingTotals(limit)
    for batch in batches:
        for depth, a, b, pa_, pb, inside, leaves, saved, given in zip(*[c.to_pylist() for c in batch.columns]):
            key = (-depth, a, b)
            if given is not None:
                queue.put(key, (given, leaves, saved))
                continue
            children, below, more = queue.take(key)
            leaves, saved = leaves + below, saved + more
            if inside:
                queue.put((1 - depth, pa_, pb), (1, leaves, saved))
            yield depth, a, b, children, leaves, saved


FORWARD = [(n, pa.int64()) for n in (*KEY, "n_children", "n_leaves", "saved_tokens")]


def _pass(nodes: DataFrame, given: DataFrame | None, parts: int, limit: int) -> DataFrame:
    """One time-forward pass over shards of pieces.

    ``nodes`` has ``KEY``, ``pa, pb``, the root of its piece and its own ``leaves, saved``; ``given``
    totals for nodes, with the root of their piece. A shard is sorted by falling depth.
    """
    columns = [*KEY, "pa", "pb", "inside", "leaves", "saved", "given"]
    nothing = F.lit(None).cast("long")
    rows = nodes.select(
        *KEY, "pa", "pb", (F.col("depth") != F.col("rd")).alias("inside"), "leaves", "saved",
        nothing.alias("given"), "rd", "ra", "rb",
    )
    if given is not None:
        zero = F.lit(0).cast("long")
        rows = rows.unionByName(given.select(
            *KEY, zero.alias("pa"), zero.alias("pb"), F.lit(False).alias("inside"), "leaves", "saved",
            "given", "rd", "ra", "rb",
        ))
    # As numbers, the order of the queue; what is given stands before its node.
    order = [F.col("depth").desc(), "a", "b", F.col("given").isNull()]
    rows = rows.repartition(parts, "rd", "ra", "rb").sortWithinPartitions(*order).select(*columns)
    schema = pa.schema(FORWARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in _forward(batches, limit):
            held.append(row)
            if len(held) == ROWS_OUT:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*held)], schema=schema)
                held = []
        if held:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*held)], schema=schema)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n, _ in FORWARD))


def subtree_totals(nodes: DataFrame, staging: Staging, waiting: int = WAITING) -> DataFrame:
    """``KEY``, ``n_children, n_leaves, saved_tokens`` of every node of ``nodes``, a written table with pieces."""
    parts = shuffle_parts(nodes.sparkSession)
    nodes = nodes.withColumns({
        "leaves": F.col("leaf").cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words"),
    })
    piece = ["rd", "ra", "rb"]
    # What each piece gives the node above it, by itself.
    root = nodes.where((F.col("depth") == F.col("rd")) & (F.col("depth") > 0))
    own = _pass(nodes, None, parts, waiting).join(root.select(*KEY, "pa", "pb"), list(KEY))
    own = staging.table(own.select(*KEY, "pa", "pb", "n_leaves", "saved_tokens"), "roots")
    edges = own.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("given"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    edges = staging.table(edges.join(nodes.select(*KEY, *piece), list(KEY)), "given")

    # Across roots: pieces that have others below them, a node for each, until all is at the top.
    inner = edges.groupBy(*piece).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    inner = inner.withColumnsRenamed({"rd": "depth", "ra": "a", "rb": "b"})
    inner = inner.join(root.select(*KEY, "pa", "pb"), list(KEY)).select(
        *KEY, (F.col("depth") - 1).alias("depth_above"), F.col("pa").alias("pa"), F.col("pb").alias("pb"), "leaves", "saved"
    )
    above = nodes.select(F.col("depth").alias("depth_above"), F.col("a").alias("pa"), F.col("b").alias("pb"), *piece)
    inner = staging.table(inner.join(above, ["depth_above", "pa", "pb"]), "inner")
    more = _across(inner, waiting)
    more = more.join(nodes.select(*KEY, *piece), list(KEY)).withColumn("given", F.lit(0).cast("long"))
    given = edges.select(*KEY, "leaves", "saved", "given", *piece).unionByName(
        more.select(*KEY, "leaves", "saved", "given", *piece)
    )
    return _pass(nodes, given, parts, waiting)


def _across(inner: DataFrame, waiting: int) -> DataFrame:
    """What pieces below inner ones add to the nodes above these: ``KEY, leaves, saved``.

    ``inner`` has one row per inner piece: its root, what the pieces right below it have given,
    the node above it and the root of that node's piece. Few pieces have others below them
    (paths of over ``LEVELS`` turns, and heavy nodes), so one task passes their totals on.
    """
    out = pa.schema([(n, pa.int64()) for n in (*KEY, "leaves", "saved")])
    columns = [*KEY, "depth_above", "pa", "pb", "rd", "ra", "rb", "leaves", "saved"]
    rows = inner.repartition(1).sortWithinPartitions(F.col("depth").desc(), "a", "b").select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = WaitingTotals(waiting)
        for batch in batches:
            held = []
            for depth, a, b, up, ua, ub, rd, ra, rb, leaves, saved in zip(*[c.to_pylist() for c in batch.columns]):
                _, below, more = queue.take((-depth, a, b))
                leaves, saved = leaves + below, saved + more
                queue.put((-rd, ra, rb), (0, leaves, saved))
                held.append((up, ua, ub, leaves, saved))
            if held:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*held)], schema=out)

    found = rows.mapInArrow(run, ", ".join(f"{n} long" for n in out.names))
    return found.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _ends(paths: DataFrame) -> DataFrame:
    """``KEY, ends_sha256`` of nodes that conversations end at: their identifiers in order, joined by commas.

    Identifiers are put together by ranges first; one hash takes those texts one after the other.
    """
    ends = paths.where(F.col("depth") == F.col("length")).select(*KEY, "conv_id")
    ids = F.array_sort(F.collect_list("conv_id"))
    lists = ends.groupBy(*KEY, F.shiftright("conv_id", IDS_BITS).alias("range")).agg(
        F.array_join(ids.cast("array<string>"), ",").alias("ids")
    )
    lists = lists.repartition(shuffle_parts(paths.sparkSession), *KEY).sortWithinPartitions(*KEY, "range")
    out = pa.schema([*[(n, pa.int64()) for n in KEY], ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, held = None, None, []
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                piece = batch.slice(a, 256)
                keys = zip(*[piece.column(c).to_pylist() for c in KEY])
                for key, ids in zip(keys, piece.column("ids").to_pylist()):
                    if key == now:
                        digest.update(b",")
                    else:
                        if now is not None:
                            held.append((*now, digest.hexdigest()))
                        now, digest = key, hashlib.sha256()
                    digest.update(ids.encode())
            if held:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)
                held = []
        if now is not None:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*[(*now, digest.hexdigest())]), out)], schema=out)

    return lists.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, turns: DataFrame, waiting: int = WAITING, heavy: int | None = None
) -> DataFrame:
    """One row per node of the trie of ``turns``: sizes, children, leaves, saved words and ends.

    ``conversations`` has the ``conv_id`` of every conversation, also of those without turns;
    ``turns`` has ``conv_id, depth, role, text``, with depths from 1 without gaps, none null (see
    :func:`placed_turns`, which makes null roles and texts empty and leaves rows without ``conv_id``
    out). Other columns are not looked at. ``conv_id`` is the smallest member and with ``depth`` names the
    node; ``parent_conv_id`` is null at the root. ``saved_tokens`` are the words that members need not
    repeat, over the subtree. Without conversations there is no node. Identifiers are unique numbers.
    ``waiting`` bounds the totals that a task holds in memory; ``heavy`` sets how many conversations
    a node has before it is heavy. Neither changes the result.
    """
    staging = stage_for(turns.sparkSession)
    paths = staging.table(trie_paths(conversations.select("conv_id"), turns), "paths")
    nodes = staging.table(_nodes(paths), "nodes")
    if heavy is None:
        root = nodes.where("depth = 0").select("n_convs").first()
        heavy = math.isqrt(root["n_convs"]) if root else 0
    nodes = staging.table(_pieces(paths, nodes, staging, heavy), "pieces")
    totals = subtree_totals(nodes, staging, waiting)
    empty = F.sha2(F.lit(b""), 256)
    found = nodes.join(totals, list(KEY)).join(_ends(paths), list(KEY), "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
