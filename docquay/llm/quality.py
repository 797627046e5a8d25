"""Quality classifier: Naive Bayes support vectors.

Features are indicators of byte n-grams and of n-grams of word shapes (case, symbols, end
marks, same word again), scaled by the log-count ratio of the two classes; on them a linear
hinge-loss model is fitted by dual coordinate descent. The rows of the
fit are dealt into blocks. In a round every block descends on its own dual variables
against the common weights, with its own change counted once per block so that the sum of
all changes is safe; the driver sees weight vectors of fixed length only, never rows.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import fold, handing_back, slices, stage_for

ORDERS = (2, 3, 4)
SHAPE_ORDERS = (2, 3)
BITS = 17
#: The fit looks at so many labelled rows at most (expected number, drawn by a hash of the id).
MAX_ROWS = 12_000
BLOCKS = 4
ROUNDS = 10
PASSES = 2
SMOOTHING = 1.0
COST = 8.0
#: Added to squared norms, as a part of their mean over the rows of the fit.
PRIOR = 0.1
#: Slope of the logistic curve that turns a margin into a score.
SLOPE = 3.0


def _byte_class(chars: str) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[[ord(c) for c in chars]] = True
    return flags


_UPPER = _byte_class(string.ascii_uppercase)
_LETTER = _byte_class(string.ascii_letters + string.digits) | (np.arange(256) >= 128)
_SYMBOL = _byte_class("".join(c for c in string.punctuation if c not in ".,;:!?'\"-()"))
_END = _byte_class(".,;:!?")
#: Letters, capitals and symbols of a byte, counted 21 bits apart.
_COUNTED = _LETTER.astype(np.int64) | _UPPER.astype(np.int64) << 21 | _SYMBOL.astype(np.int64) << 42
_MIX = np.uint32(0x9E3779B1)


def word_shapes(raw: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A number below 128 for every word between white space.

    ``codes`` has the four bytes from each place on; words whose codes have the same sum
    count as the same word.
    """
    inside = raw > 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if inside[0]:
        starts = np.concatenate([[0], starts])
    if not len(starts):
        return np.empty(0, np.uint32)
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    if inside[-1]:
        ends = np.append(ends, len(raw) - 1)
    counts = np.add.reduceat(_COUNTED[raw], starts)
    letters, upper, symbols = counts & 0x1FFFFF, counts >> 21 & 0x1FFFFF, counts >> 42
    own = np.add.reduceat(codes * _MIX ^ codes >> np.uint32(15), starts, dtype=np.uint32)
    again, after = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
    again[1:] = own[1:] == own[:-1]
    after[2:] = own[2:] == own[:-2]
    bits = [_UPPER[raw[starts]], (upper > 1) & (2 * upper >= letters), symbols > 0,
            _END[raw[ends]], again, after, letters == 0]
    shape = np.zeros(len(starts), dtype=np.uint32)
    for k, bit in enumerate(bits):
        shape |= bit.astype(np.uint32) << np.uint32(k)
    return shape


def ngram_indicators(text: bytes, orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> np.ndarray:
    """Sorted distinct features of the UTF-8 bytes, and of the word shapes, of a whole text.

    N-grams of up to four bytes or three shapes; an n-gram that reaches over the end of the
    text is filled with zero bytes.
    """
    flags = np.zeros(1 << bits, dtype=bool)
    if not text:
        return np.flatnonzero(flags)
    padded, shift = text + b"\0\0\0", np.uint32(32 - bits)
    codes = np.ndarray((len(text),), dtype="<u4", buffer=padded, strides=(1,)).astype(np.uint32)
    shapes = word_shapes(np.frombuffer(text, dtype=np.uint8), codes)
    for n in orders:
        grams = codes & np.uint32((1 << 8 * n) - 1) if n < 4 else codes
        flags[((grams ^ np.uint32(n << 28)) * _MIX >> shift).astype(np.intp)] = True
    for n in SHAPE_ORDERS:
        if len(shapes) >= n:
            grams = np.full(len(shapes) - n + 1, n + 100, dtype=np.uint32)
            for k in range(n):
                grams = grams << np.uint32(7) | shapes[k : len(shapes) - n + 1 + k]
            flags[(grams * np.uint32(0x85EBCA6B) >> shift).astype(np.intp)] = True
    return np.flatnonzero(flags)


@dataclass(frozen=True)
class QualityModel:
    """``weights`` already holds ratio times hinge weight; ``ratios`` gives a text's norm.

    ``prior`` is added to the squared norm, so a text of few n-grams stays near the bias.
    """

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    orders: tuple[int, ...]
    bits: int

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Between 0 and 1, higher where label 1 is likelier; null and empty texts too."""
        out = np.empty(len(texts))
        raw = pc.cast(pc.fill_null(texts, ""), pa.binary())
        for i, text in enumerate(raw):
            ids = ngram_indicators(text.as_buffer().to_pybytes(), self.orders, self.bits)
            norm = np.sqrt(np.square(self.ratios[ids]).sum() + self.prior)
            out[i] = self.weights[ids].sum() / norm + self.bias
        return 1.0 / (1.0 + np.exp(-SLOPE * out))


def _packed(ids: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences."""
    return zlib.compress(np.diff(ids, prepend=0).astype(np.uint32).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), dtype=np.uint32), dtype=np.int32)


def _featurize(orders: tuple[int, ...], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                texts = pc.cast(pc.fill_null(piece.column("text"), ""), pa.binary())
                rows = [
                    _packed(ngram_indicators(t.as_buffer().to_pybytes(), orders, bits))
                    for t in texts
                ]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("block"), piece.column("key"), piece.column("label"),
                     pa.array(rows, pa.binary())],
                    names=["block", "key", "label", "features"],
                )

    return handing_back(run)


def _counts(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << bits), dtype=np.int64)
        for batch in batches:
            for label, row in zip(batch.column("label").to_pylist(), batch.column("features")):
                sums[label][_unpacked(row.as_buffer())] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1]), pa.array([sums[0].tobytes(), sums[1].tobytes()], pa.binary())],
            names=["label", "sums"],
        )

    return handing_back(run)


def _norms(ratios, bits: int):
    """Sum of squared norms of the rows of each task, for the mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_unpacked(x.as_buffer()) for x in batch.column("features")]
            square = [float(np.square(ratios[r]).sum()) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(square)], names=["square"])

    return handing_back(run)


def _descend(ratios, weights, bias, prior, alphas, blocks, cost, passes):
    """One round over each block: change of weights and bias, and the new dual variables."""

    def descend(block: int, labels: pa.Array, features: pa.Array) -> tuple:
        rows = [_unpacked(x.as_buffer()) for x in features]
        sign = np.where(labels.to_numpy(zero_copy_only=False) == 1, 1.0, -1.0)
        alpha = alphas.get(block, np.zeros(len(rows))).copy()
        norms = [np.sqrt(np.square(ratios[r]).sum() + prior) for r in rows]
        square = [np.square(ratios[r]).sum() / n**2 + 1.0 for r, n in zip(rows, norms)]
        moved, moved_bias = np.zeros_like(weights), 0.0
        order = np.random.default_rng(7)
        for _ in range(passes):
            for i in order.permutation(len(rows)):
                r = rows[i]
                x = ratios[r] / norms[i]
                margin = x @ (weights[r] + blocks * moved[r]) + bias + blocks * moved_bias
                step = (1.0 - sign[i] * margin) / (blocks * square[i])
                new = min(max(alpha[i] + step, 0.0), cost)
                if new != alpha[i]:
                    change = (new - alpha[i]) * sign[i]
                    moved[r] += change * x
                    moved_bias += change
                    alpha[i] = new
        return block, moved.tobytes(), float(moved_bias), alpha.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("labels"), batch.column("features")
            for k, block in enumerate(batch.column("block").to_pylist()):
                out = descend(block, *(column[k].values for column in lists))
                kinds = (pa.int32(), pa.binary(), pa.float64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], kind) for x, kind in zip(out, kinds)],
                    names=["block", "moved", "bias", "alpha"],
                )

    return handing_back(run)


def fit_quality(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "quality",
    id_col: str = "doc_id",
    max_rows: int = MAX_ROWS,
    orders: tuple[int, ...] = ORDERS,
    bits: int = BITS,
    rounds: int = ROUNDS,
) -> QualityModel:
    """Fit on rows with a label of 0 or 1; other and null labels are left out.

    Of more than ``max_rows`` such rows a part is drawn by a hash of the identifier, so
    memory does not depend on the table. Null texts count as empty. Repeated rows weigh
    as often as they occur. With no rows, or one class only, every text gets the same
    score: that class, or 0.5 where nothing was labelled.
    """
    spark, staging = labelled.sparkSession, stage_for(labelled.sparkSession)
    rows = labelled.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.col(text_col).alias("text"),
        F.col(label_col).cast("int").alias("label"),
    ).where(F.col("label").isin(0, 1))
    n = rows.count()
    draw = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 30))
    rows = rows.where(draw < int(min(1.0, max_rows / max(n, 1)) * (1 << 30)))
    rows = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(BLOCKS)).cast("int").alias("block"),
        F.xxhash64("id").alias("key"), "label", "text",
    )
    schema = "block int, key long, label int, features binary"
    table = staging.table(rows.mapInArrow(_featurize(orders, bits), schema), "features")

    size = 1 << bits
    sums = np.zeros((2, size))
    parts = table.coalesce(BLOCKS).mapInArrow(_counts(bits), "label long, sums binary")
    for label, part in parts.toLocalIterator():
        sums[label] += np.frombuffer(part, dtype=np.int64)
    seen = [table.where(F.col("label") == k).count() for k in (0, 1)]
    flat = QualityModel(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, 1.0, orders, bits)
    if not all(seen):
        sure = 0.0 if not any(seen) else (2.0 if seen[1] else -2.0)
        return QualityModel(flat.ratios, flat.weights, sure, 1.0, orders, bits)
    p, q = sums[1] + SMOOTHING, sums[0] + SMOOTHING
    ratios = np.log((p / p.sum()) / (q / q.sum()))
    ratios[(sums[0] + sums[1]) == 0] = 0.0

    squares = table.select("features").mapInArrow(_norms(ratios, bits), "square double")
    prior = max(squares.agg(F.avg("square")).first()[0], 1e-9) * PRIOR

    # A block is one row from here on, in a fixed order, so that no round moves rows again.
    entries = F.sort_array(F.collect_list(F.struct("key", "label", "features")))
    blocks = table.repartition(BLOCKS, "block").groupBy("block").agg(entries.alias("rows"))
    blocks = blocks.select(
        "block", F.col("rows.label").alias("labels"), F.col("rows.features").alias("features")
    )
    blocks = staging.table(blocks, "blocks")

    weights, bias, alphas = np.zeros(size), 0.0, {}
    for _ in range(rounds):
        step = _descend(ratios, weights, bias, prior, alphas, BLOCKS, COST, PASSES)
        out = blocks.mapInArrow(step, "block int, moved binary, bias double, alpha binary")
        for block, moved, moved_bias, alpha in sorted(out.toLocalIterator()):
            weights = weights + np.frombuffer(moved)
            bias += moved_bias
            alphas[block] = np.frombuffer(alpha)
    staging.discard()
    return QualityModel(
        ratios.astype(np.float32), (ratios * weights).astype(np.float32), float(bias),
        float(prior), orders, bits,
    )


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score, predicted`` for every row, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                scores = model.scores(piece.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(scores),
                     pa.array((scores >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(handing_back(run), "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                yield piece.filter(pa.array(model.scores(piece.column(text_col)) >= 0.5))

    return docs.mapInArrow(handing_back(run), docs.schema)


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with a label, of the folds that are learned from."""
    labels = labels.where(fold("doc_id", 3) != 1).select("doc_id", "quality")
    return docs.select("doc_id", "text").where(fold("doc_id", 3) != 1).join(labels, "doc_id")
