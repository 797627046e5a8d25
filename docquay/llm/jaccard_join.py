"""N-gram Jaccard join with signature trees.

A document is the set of its distinct word shingles. Two sets can only be similar enough if
they share a shingle among the first ones of each in one common order (prefix filter). The
order puts shingles that a fixed-size sketch has seen often last, so a passage that many
documents repeat does not bring them together. Sets that share such a shingle are a bucket.

Inside a bucket the pairs come from a signature tree. Its leaves are pages of sets of about
the same size, its nodes hold the OR of the bitmaps below them, the range of sizes and the
range of components. Node pairs are followed from the roots down, and dropped where the
sizes cannot match, where the bitmaps allow too little overlap, or where everything is
connected already. Two pages are compared by the buckets that their sets are in: those tell how
many first shingles two sets share, hence how many they share at most, and in which one of their
common buckets the pair is told. Pairs that survive are compared exactly.

Before the trees, every set is compared with a leader of its buckets: the set of about its
size that shares most with others, since that one is near the middle of its group and in reach of
sets that are not in reach of each other. In a group of many near copies that connects nearly
everything with a number of comparisons that is proportional to the group, so the trees have
little left to look at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import (
    ascii_words,
    handing_back,
    keep_rows,
    row_hash,
    rows_at_once,
    shuffle_parts,
    slices,
    stage_for,
    thinned,
)
from docquay.llm.components import components
from docquay.sources.staging import Staging

SHINGLE = 5
#: Similarity as a fraction of whole numbers, so that the comparison is exact.
SIMILARITY = (75, 100)
SKETCH_BITS = 23
SKETCH_BLOCK = 1 << 16
PAGE = 48
FAN_OUT = 16
#: Buckets that two pages are compared by at once; only bounds memory.
MARKS_AT_ONCE = 4096
#: Rows with lists of bitmaps that a task turns into objects together.
ROWS_AT_ONCE = 64
#: Leaders that a set is compared with before the trees.
LEADERS = 3


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of every text.

    A text with fewer than ``size`` words has its whole sequence as one shingle; one
    without words, or null, has none.
    """
    rows, flat = ascii_words(texts)
    if not len(flat):
        return [np.empty(0, np.uint64)] * len(texts)
    words = flat.dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    own = [xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()]
    token = np.array(own, dtype=np.uint64)[words.indices.to_numpy()]
    ends = np.searchsorted(rows, np.arange(len(texts) + 1))
    n = max(len(token) - size + 1, 0)
    mixed = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + token[k : k + n]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    out = []
    for a, b in zip(ends, ends[1:]):
        if b - a >= size:
            out.append(np.unique(mixed[a : b - size + 1]))
        elif b > a:
            whole = xxhash.xxh3_64_intdigest(token[a:b].tobytes(), seed=int(b - a))
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def least_overlap(total: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """Smallest overlap of two sets of ``total`` elements together that are similar enough."""
    num, den = similarity
    return -(-total * num // (num + den))


def similar(n: int, m: int, overlap: int, similarity: tuple[int, int] = SIMILARITY) -> bool:
    return similarity[1] * overlap >= similarity[0] * (n + m - overlap)


def prefix_length(n: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """So many first shingles must hold one of any similar set's first shingles."""
    return n - -(-n * similarity[0] // similarity[1]) + 1 if n else 0


def bitmap(values: np.ndarray) -> np.ndarray:
    """Bits of the lowest hash bits; at least two bits per element, a power of two long."""
    size = max(64, 1 << (2 * len(values) - 1).bit_length())
    flags = np.zeros(size, dtype=bool)
    flags[values & np.uint64(size - 1)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


def tiled(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap repeated to a longer length: it then covers at least what it did."""
    return np.tile(bits, words // len(bits))


# --- sketch of shingle frequencies ------------------------------------------------------


def _sketch(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            for piece in slices(batch):
                sets = shingle_sets(piece.column("text"), size)
                cells = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
                cells, times = np.unique(cells.astype(np.int64), return_counts=True)
                counts[cells] += times.astype(np.uint32)
        blocks = counts.reshape(-1, SKETCH_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()),
             pa.array([zlib.compress(b.tobytes(), 1) for b in blocks], pa.binary())],
            names=["block", "counts"],
        )

    return handing_back(run)


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts")):
            part = np.frombuffer(zlib.decompress(raw.as_buffer()), dtype=np.uint32)
            sums.setdefault(block, np.zeros(SKETCH_BLOCK, dtype=np.uint64))
            sums[block] += part
    weights = [
        np.rint(2.0 * np.log2(total.astype(np.float64) + 1.0)).astype(np.uint8).tobytes()
        for total in sums.values()
    ]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array(weights, pa.binary())],
        names=["block", "weights"],
    )


def frequency_weights(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Order of magnitude of how often the shingles of each sketch cell occur.

    Every document is counted. The sketch has a fixed number of cells, so what the driver
    receives and sends out does not grow with the input; collisions only blur the order.
    """
    parts = docs.select("text").mapInArrow(_sketch(size), "block int, counts binary")
    blocks = (1 << SKETCH_BITS) // SKETCH_BLOCK
    rows = parts.repartition(min(blocks, shuffle_parts(docs.sparkSession)), "block").mapInArrow(
        _weigh, "block int, weights binary"
    )
    out = np.zeros((blocks, SKETCH_BLOCK), dtype=np.uint8)
    for block, weights in rows.toLocalIterator():
        out[block] = np.frombuffer(weights, dtype=np.uint8)
    return out.reshape(-1)


# --- profiles and buckets ---------------------------------------------------------------


def place_of(weight: int, shingle: int) -> int:
    """A number that does not decrease along the order of shingles: by weight, then by hash."""
    return weight << 55 | shingle >> 9


def _profile(weights, size: int, similarity: tuple[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                sets = shingle_sets(piece.column("text"), size)
                first, reach = [], []
                for s in sets:
                    heavy = weights.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    order = np.argsort(heavy, kind="stable")[: prefix_length(len(s), similarity)]
                    first.append(s[order].tobytes())
                    reach.append(place_of(int(heavy[order[-1]]), int(s[order[-1]])) if len(s) else 0)
                maps = [bitmap(s) for s in sets]
                spare = [len(s) - int(np.bitwise_count(m).sum()) for s, m in zip(sets, maps)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("row_hash"),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(spare, pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array(first, pa.binary()), pa.array(reach, pa.int64()),
                     pa.array([m.tobytes() for m in maps], pa.binary())],
                    names=["doc_id", "row_hash", "n", "spare", "digest", "first", "reach", "bits"],
                )

    return handing_back(run)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = batch.column("first")
        counts = pc.binary_length(raw).to_numpy(zero_copy_only=False) // 8
        tokens = np.frombuffer(b"".join(x.as_buffer() for x in raw), dtype=np.int64)
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), counts)
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(nodes)], names=["token", "node"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, those whose token has more than one row.

    The last row of a batch waits for the first token of the next one.
    """
    token, node, open_run = np.empty(0, np.int64), np.empty(0, np.int64), False
    for batch in batches:
        token = np.concatenate([token, batch.column("token").to_numpy(zero_copy_only=False)])
        node = np.concatenate([node, batch.column("node").to_numpy(zero_copy_only=False)])
        if len(token) < 2:
            continue
        equal = token[1:] == token[:-1]
        many = np.concatenate([[open_run], equal])
        many[:-1] |= equal
        many = many[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(token[:-1][many]), pa.array(node[:-1][many])], names=["token", "node"]
        )
        token, node, open_run = token[-1:], node[-1:], bool(equal[-1])
    if open_run:
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(node)], names=["token", "node"])


# --- exact comparison -------------------------------------------------------------------


def _sets_of(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                sets = [s.tobytes() for s in shingle_sets(piece.column("text"), size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                     pa.array(sets, pa.binary())],
                    names=["digest", "members"],
                )

    return handing_back(run)


def _compare(similarity: tuple[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(similar(len(x), len(y), both, similarity))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(good, pa.bool_()))

    return handing_back(run)


class _Sets:
    """Whole shingle sets of the classes that are compared, made again from the texts when needed.

    Only texts whose hash is wanted are looked at; nothing keeps the sets of all documents.
    """

    def __init__(self, rows: DataFrame, classes: DataFrame, size: int, staging: Staging) -> None:
        self.rows, self.classes, self.size, self.staging = rows, classes, size, staging
        self.tables: list[DataFrame] = []
        self.calls = 0

    def _all(self) -> DataFrame:
        out = self.tables[0]
        for table in self.tables[1:]:
            out = out.union(table)
        return out

    def of(self, pairs: DataFrame) -> DataFrame:
        """``cls, members`` of all classes in ``pairs(a, b)``, and of some others."""
        needed = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        if self.tables:
            needed = needed.join(self._all().select("cls"), "cls", "left_anti")
        needed = needed.join(self.classes.select("cls", "digest", "row_hash"), "cls")
        step, self.calls = self.calls, self.calls + 1
        needed = self.staging.table(needed, f"needed-{step}")
        if step and needed.isEmpty():
            return self._all()
        texts = thinned(self.rows.select("row_hash", "text"), needed, "row_hash").select("text")
        found = texts.mapInArrow(_sets_of(self.size), "digest binary, members binary")
        found = found.dropDuplicates(["digest"]).join(needed, "digest").select("cls", "members")
        self.tables.append(self.staging.table(found, f"sets-{step}"))
        return self._all()


def _bitmaps_allow(similarity: tuple[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "m", "s", "t")]
            good = []
            for n, m, s, t, x, y in zip(*facts, batch.column("x"), batch.column("y")):
                x = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                words = max(len(x), len(y))
                both = int(np.bitwise_count(tiled(x, words) & tiled(y, words)).sum())
                good.append(both + min(s, t) >= least_overlap(int(n + m), similarity))
            keep = ["a", "b", "common"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep], names=keep
            ).filter(pa.array(good, pa.bool_()))

    return handing_back(run)


def _allowed(offers: DataFrame, classes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The ``offers(a, b, common)`` whose bitmaps leave room for enough overlap."""
    left = classes.select(F.col("cls").alias("a"), F.col("n"), F.col("spare").alias("s"), F.col("bits").alias("x"))
    right = classes.select(
        F.col("cls").alias("b"), F.col("n").alias("m"), F.col("spare").alias("t"), F.col("bits").alias("y")
    )
    rows = offers.join(right, "b").join(left, "a").select("a", "b", "common", "n", "m", "s", "t", "x", "y")
    return rows.mapInArrow(_bitmaps_allow(similarity), "a long, b long, common long")


def verified(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The ``pairs(a, b)`` whose ``sets(cls, members)`` are similar enough."""
    left = sets.select(F.col("cls").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("members").alias("y"))
    rows = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return rows.mapInArrow(_compare(similarity), "a long, b long")


# --- signature trees --------------------------------------------------------------------


def _or_bits(maps: list[np.ndarray]) -> np.ndarray:
    words = max(map(len, maps))
    out = np.zeros(words, dtype=np.uint64)
    for bits in maps:
        out |= tiled(bits, words)
    return out


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """OR the bitmaps of the children of each node."""
    for whole in batches:
        for batch in rows_at_once(whole, ROWS_AT_ONCE):
            maps = [
                _or_bits([np.frombuffer(b, dtype=np.uint64) for b in children]).tobytes()
                for children in batch.column("children").to_pylist()
            ]
            keep = [c for c in batch.schema.names if c != "children"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(maps, pa.binary())], names=[*keep, "bits"]
            )


NODE = "token long, band int, slot long, n_min long, n_max long, c_min long, c_max long, spare long, bits binary"


def tree_levels(members: DataFrame, levels: int, staging: Staging, name: str) -> list[DataFrame]:
    """Node tables from the pages up; a node has ``FAN_OUT`` children at most."""
    out = []
    for level in range(levels + 1):
        source = members if level == 0 else out[-1].withColumn("slot", F.shiftright("slot", 4))
        ranges = [("n_min", F.min, "n"), ("n_max", F.max, "n"), ("c_min", F.min, "comp"),
                  ("c_max", F.max, "comp"), ("spare", F.max, "spare")]
        aggs = [f(c if level == 0 or c == "spare" else name).alias(name) for name, f, c in ranges]
        rows = source.groupBy("token", "band", "slot").agg(*aggs, F.collect_list("bits").alias("children"))
        out.append(staging.table(rows.mapInArrow(handing_back(_nodes), NODE), f"{name}-nodes-{level}"))
    return out


def _possible(similarity: tuple[int, int]) -> Callable:
    """Keep the node pairs below which a new similar pair may be."""
    num, den = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = ["n_min", "n_max", "c_min", "c_max", "spare"]
        for batch in batches:
            x, y = ({f: batch.column(f"{side}{f}").to_numpy(zero_copy_only=False) for f in facts} for side in "xy")
            one = (x["c_min"] == x["c_max"]) & (y["c_min"] == y["c_max"]) & (x["c_min"] == y["c_min"])
            apart = (den * x["n_max"] < num * y["n_min"]) | (den * y["n_max"] < num * x["n_min"])
            good = ~one & ~apart
            spare = np.minimum(x["spare"], y["spare"])
            maps = batch.column("xbits"), batch.column("ybits")
            for k in np.flatnonzero(good).tolist():
                u, v = (np.frombuffer(m[k].as_buffer(), dtype=np.uint64) for m in maps)
                words = max(len(u), len(v))
                both = int(np.bitwise_count(tiled(u, words) & tiled(v, words)).sum())
                good[k] = both + spare[k] >= least_overlap(int(x["n_min"][k] + y["n_min"][k]), similarity)
            keep = ["token", "xband", "xslot", "yband", "yslot"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep], names=keep
            ).filter(pa.array(good, pa.bool_()))

    return handing_back(run)


PAIR = "token long, xband int, xslot long, yband int, yslot long"


def _numbered(page: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number in the page of the set of each mark, its bucket, and the first shingles it stands for."""
    marks, times = page.field("marks"), page.field("times")
    counts = pc.list_value_length(marks).to_numpy(zero_copy_only=False)
    flat = (a.flatten().to_numpy(zero_copy_only=False) for a in (marks, times))
    return np.repeat(np.arange(len(page)), counts), *flat


def shared_marks(page_x: pa.StructArray, page_y: pa.StructArray, token: int) -> tuple[np.ndarray, np.ndarray]:
    """First shingles that each set of one page shares with each of the other, and
    whether they are in a common bucket before ``token``."""
    (rows, at, times), (cols, to, _) = _numbered(page_x), _numbered(page_y)
    both = np.intersect1d(at, to)
    shape = len(page_x), len(page_y)
    shared, before = np.zeros(shape), np.zeros(shape, dtype=bool)
    for k in range(0, len(both), MARKS_AT_ONCE):
        some = both[k : k + MARKS_AT_ONCE]
        x, y = np.zeros((shape[0], len(some))), np.zeros((shape[1], len(some)))
        here, there = np.isin(at, some), np.isin(to, some)
        x[rows[here], np.searchsorted(some, at[here])] = times[here]
        y[cols[there], np.searchsorted(some, to[there])] = 1
        shared += x @ y.T
        cut = np.searchsorted(some, token)
        before |= x[:, :cut] @ y[:, :cut].T > 0
    return shared.astype(np.int64), before


def most_overlap(
    n: np.ndarray, m: np.ndarray, reach_x: np.ndarray, reach_y: np.ndarray, shared: np.ndarray, similarity: tuple[int, int]
) -> np.ndarray:
    """So many elements at most have sets in common that share ``shared`` of their first shingles.

    Of the set whose first shingles end earlier in the order, these meet only first shingles
    of the other; what they do not meet is not in it. ``reach`` is the place of the last ones.
    """
    num, den = similarity
    rest_x, rest_y = -(-n * num // den) - 1, -(-m * num // den) - 1
    rest = np.where(reach_x < reach_y, rest_x, np.where(reach_x > reach_y, rest_y, np.maximum(rest_x, rest_y)))
    return shared + rest


def _page_pairs(similarity: tuple[int, int], brought: list[str]) -> Callable:
    """Pairs of sets of two pages that bitmaps and sizes allow and that are not yet connected.

    Where pages have ``marks``, so must the first shingles that the sets share, and a pair is
    told in the first of the buckets only that have both.
    """
    num, den = similarity

    def pairs_of(page_x: pa.StructArray, page_y: pa.StructArray, same: bool, token: int) -> set:
        xs, ys = ({f: page.field(f).to_numpy(zero_copy_only=False) for f in ("cls", "comp", "n", "spare")}
                  for page in (page_x, page_y))
        n, m = xs["n"][:, None], ys["n"]
        ok = (xs["comp"][:, None] != ys["comp"]) & (den * n >= num * m) & (den * m >= num * n)
        if same:
            ok = np.triu(ok, 1)
        if "marks" in brought and ok.any():
            shared, before = shared_marks(page_x, page_y, token)
            reach_x, reach_y = (page.field("reach").to_numpy(zero_copy_only=False) for page in (page_x, page_y))
            most = most_overlap(n, m, reach_x[:, None], reach_y, shared, similarity)
            ok &= ~before & (most >= least_overlap(n + m, similarity))
        maps: dict[tuple[int, int], np.ndarray] = {}

        def bits(side: int, page: pa.StructArray, k: int) -> np.ndarray:
            if (side, k) not in maps:
                maps[side, k] = np.frombuffer(page.field("bits")[k].as_buffer(), dtype=np.uint64)
            return maps[side, k]

        found = set()
        for i in np.flatnonzero(ok.any(axis=1)).tolist():
            for j in np.flatnonzero(ok[i]).tolist():
                u, v = bits(0, page_x, i), bits(1, page_y, j)
                words = max(len(u), len(v))
                both = int(np.bitwise_count(tiled(u, words) & tiled(v, words)).sum())
                total = int(xs["n"][i] + ys["n"][j])
                if both + min(xs["spare"][i], ys["spare"][j]) >= least_overlap(total, similarity):
                    found.add(tuple(sorted((int(xs["cls"][i]), int(ys["cls"][j])))))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[int, int]] = set()
            places = [batch.column(c).to_pylist() for c in ("xband", "xslot", "yband", "yslot", "token")]
            for k, (xband, xslot, yband, yslot, token) in enumerate(zip(*places)):
                pages = (batch.column(c)[k].values for c in ("xpage", "ypage"))
                found |= pairs_of(*pages, (xband, xslot) == (yband, yslot), token)
            a, b = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    return handing_back(run)


def size_band(similarity: tuple[int, int]) -> Column:
    """Number of a range of sizes; similar sets are in the same or in neighbouring ranges."""
    step = math.log(similarity[1] / similarity[0])
    return F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("int")


def tree_pairs(
    members: DataFrame, staging: Staging, similarity: tuple[int, int], name: str, maps: DataFrame | None = None
) -> DataFrame:
    """Pairs ``a, b`` that the signature trees of ``members(token, cls, comp, n, spare, bits)`` leave.

    A tree has the sets of a bucket and of a range of sizes, such that similar sets are in
    the same or in neighbouring ranges. Pages are dealt by a hash of the set. ``maps(cls, bits)``
    may hold the bitmaps instead, one row for each set; a set is in many buckets, so its bitmap
    is brought to them only where nodes are made, and once more for the pages that are left.

    ``maps`` may also have ``marks``, all buckets of the set that are not of one component,
    ``times``, how many of its first shingles each of them stands for, and ``reach``, the place
    of its last first shingle. Then pairs that share too few first shingles are left out.
    """
    if maps is None:
        maps = members.select("cls", "bits").dropDuplicates(["cls"])
    rows = members.select("token", "cls", "comp", "n", "spare", size_band(similarity).alias("band"))
    counts = rows.groupBy("token", "band").agg(F.ceil(F.count("*") / F.lit(PAGE)).alias("pages"))
    rows = rows.join(counts, ["token", "band"]).withColumn(
        "slot", F.pmod(F.xxhash64("cls"), F.col("pages")).cast("long")
    ).drop("pages")
    rows = staging.table(rows, f"{name}-members")
    top = rows.agg(F.max("slot")).first()[0] or 0
    levels = 0
    while top >> (4 * levels):
        levels += 1
    nodes = tree_levels(rows.join(maps.select("cls", "bits"), "cls"), levels, staging, name)

    def side(df: DataFrame, tag: str, columns: list[str]) -> DataFrame:
        return df.select("token", *[F.col(c).alias(f"{tag}{c}") for c in columns])

    facts = ["band", "slot", "n_min", "n_max", "c_min", "c_max", "spare", "bits"]
    roots = nodes[levels]
    x, y = side(roots, "x", facts), side(roots, "y", facts)
    near = (F.col("yband") - F.col("xband")).isin(0, 1)
    pairs = x.join(y, "token").where(near & ~((F.col("yband") == F.col("xband")) & (F.col("yslot") < F.col("xslot"))))
    pairs = pairs.mapInArrow(_possible(similarity), PAIR)
    for level in range(levels - 1, -1, -1):
        pairs = staging.table(pairs, f"{name}-pairs-{level}")
        x, y = side(nodes[level], "x", facts), side(nodes[level], "y", facts)
        up = pairs.select("token", "xband", "yband", F.col("xslot").alias("xup"), F.col("yslot").alias("yup"))
        grown = (
            up.join(x.withColumn("xup", F.shiftright("xslot", 4)), ["token", "xband", "xup"])
            .join(y.withColumn("yup", F.shiftright("yslot", 4)), ["token", "yband", "yup"])
            .where((F.col("xband") != F.col("yband")) | (F.col("xslot") <= F.col("yslot")))
        )
        pairs = grown.mapInArrow(_possible(similarity), PAIR)
    pairs = staging.table(pairs, f"{name}-pairs")
    brought = [c for c in maps.columns if c != "cls"]
    page = F.collect_list(F.struct("cls", "comp", "n", "spare", *brought)).alias("page")
    left = pairs.select("token", F.col("xband").alias("band"), F.col("xslot").alias("slot")).union(
        pairs.select("token", "yband", "yslot")
    ).distinct()
    pages = rows.join(left, ["token", "band", "slot"]).join(maps, "cls")
    pages = pages.groupBy("token", "band", "slot").agg(page)
    final = pairs.join(side(pages, "x", ["band", "slot", "page"]), ["token", "xband", "xslot"]).join(
        side(pages, "y", ["band", "slot", "page"]), ["token", "yband", "yslot"]
    )
    found = staging.table(
        final.mapInArrow(_page_pairs(similarity, brought), "a long, b long").distinct(), f"{name}-found"
    )
    for table in ("members", "pairs", *[f"pairs-{k}" for k in range(levels)]):
        staging.drop(f"{name}-{table}")
    for level in range(levels + 1):
        staging.drop(f"{name}-nodes-{level}")
    return found


# --- the join ---------------------------------------------------------------------------


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """``doc_id, row_hash, n_shingles, component_id`` of every row.

    Sets are linked if their Jaccard similarity is at least ``similarity`` (exact, by whole
    numbers); ``component_id`` is the smallest identifier that links reach, the row's own
    included. Words are what ASCII white space separates, A-Z lowered. Null, empty and blank
    texts have no shingle and are linked with nothing. A null identifier takes part, but names
    a component only if there is no other. Repeated rows, and rows that share an identifier,
    are rows of their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    staging = stage_for(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        row_hash(F.col(text_col)).alias("row_hash"), F.col(text_col).alias("text"),
    )
    weights = spark.sparkContext.broadcast(frequency_weights(rows, size))
    profile = rows.mapInArrow(
        _profile(weights, size, similarity),
        "doc_id long, row_hash long, n long, spare long, digest binary, first binary, reach long, bits binary",
    ).withColumn("node", F.monotonically_increasing_id())
    profile = staging.table(profile, "profile")
    weights.destroy()

    postings = profile.where("n > 0").select("node", "first").mapInArrow(
        handing_back(_postings), "token long, node long"
    )
    shared = (
        postings.repartition(shuffle_parts(spark), "token").sortWithinPartitions("token")
        .mapInArrow(handing_back(_shared), "token long, node long")
    )
    shared = staging.table(shared, "shared")
    narrow = staging.table(profile.drop("first"), "narrow")
    staging.drop("profile")

    # Equal sets are one class, named by its first node; everything below is about classes.
    full = narrow.where("n > 0")
    first = F.min_by(F.struct(F.col("node").alias("cls"), "n", "spare", "reach", "bits", "row_hash"), "node")
    classes = full.groupBy("digest").agg(first.alias("c")).select("digest", "c.*")
    classes = staging.table(classes, "classes")
    node_class = full.select("node", "digest").join(classes.select("digest", "cls", "n"), "digest")

    buckets = shared.join(node_class, "node").select("token", "cls", "n").distinct()
    buckets = staging.table(buckets, "buckets-all")
    staging.drop("shared")
    # Buckets with the same classes as another one add nothing.
    bags = buckets.groupBy("token").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("cls")).alias("bag"), F.min("cls").alias("low")
    ).where("size > 1")
    bags = bags.groupBy("size", "bag", "low").agg(
        F.min("token").alias("token"), F.count("*").cast("int").alias("times")
    )
    buckets = staging.table(buckets.join(bags.select("token", "size", "times"), "token"), "buckets")
    staging.drop("buckets-all")

    # Every class against the leaders it shares most buckets with; it has no more offers
    # than first shingles, so the list of them is short.
    sets = _Sets(rows, classes, size, staging)
    central = buckets.groupBy("cls").agg(F.sum("size").alias("met"))
    banded = buckets.withColumn("band", size_band(similarity))
    leads = banded.join(central, "cls").groupBy("token", "band").agg(
        F.max_by(F.struct("cls", "n"), F.struct("met", -F.col("cls"))).alias("lead")
    )
    around = F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])).alias("band")
    leads = leads.select("token", "lead", around)
    num, den = similarity
    close = (F.col("n") * den >= F.col("lead.n") * num) & (F.col("lead.n") * den >= F.col("n") * num)
    offers = (
        banded.join(leads, ["token", "band"]).where((F.col("cls") != F.col("lead.cls")) & close)
        .groupBy(F.col("lead.cls").alias("a"), F.col("cls").alias("b")).agg(F.count("*").alias("common"))
    )
    offers = _allowed(offers, classes, similarity)
    ranked = F.sort_array(F.collect_list(F.struct("common", (-F.col("a")).alias("a"))), asc=False)
    best = offers.groupBy("b").agg(F.slice(ranked, 1, LEADERS).alias("best"))
    best = best.select("b", F.explode("best.a").alias("a")).select((-F.col("a")).alias("a"), "b")
    pairs = staging.table(best, "leaders")
    edges = staging.table(verified(pairs, sets.of(pairs), similarity), "links")
    labels = staging.table(components(edges, staging, "parts-1"), "labels-1")

    live = staging.table(_live_buckets(buckets, labels), "live")
    marks = live.groupBy("cls").agg(F.collect_list(F.struct("token", "times")).alias("m"))
    maps = classes.join(marks, "cls").select(
        "cls", "spare", "reach", "bits", F.col("m.token").alias("marks"), F.col("m.times").alias("times")
    )
    maps = staging.table(maps, "live-maps")
    members = live.drop("times").join(maps.select("cls", "spare"), "cls")
    pairs = tree_pairs(members, staging, similarity, "tree", maps.drop("spare"))
    for name in ("live", "live-maps"):
        staging.drop(name)
    edges = edges.union(staging.table(verified(pairs, sets.of(pairs), similarity), "links-tree"))
    labels = staging.table(components(edges, staging, "parts-2"), "labels-2")

    tagged = narrow.join(node_class.select("node", "cls"), "node", "left").withColumn(
        "cls", F.coalesce("cls", "node")
    ).select("doc_id", "row_hash", "n", "cls")
    tagged = tagged.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "doc_id", "row_hash", "n", F.coalesce("component", "cls").alias("component")
    )
    tagged = staging.table(tagged, "tagged")
    for name in ("buckets", "classes", "narrow", *[f"sets-{k}" for k in range(sets.calls)]):
        staging.drop(name)
    least = tagged.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return tagged.join(least, "component").select(
        "doc_id", "row_hash", F.col("n").alias("n_shingles"), "component_id"
    )


def _live_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``token, cls, n, times, comp`` of the buckets that more than one component shares."""
    named = buckets.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "token", "cls", "n", "times", F.coalesce("component", "cls").alias("comp")
    )
    apart = named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return named.join(apart.where("lo < hi").select("token"), "token")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest identifier; all columns."""
    found = jaccard_components(docs, id_col, text_col)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = stage_for(docs.sparkSession).table(kept.select("doc_id", "row_hash"), "kept")
    return keep_rows(docs, kept, id_col, text_col)
