"""Language identification of mixed-language text.

Every word gets a score for each learned language from its character n-grams. Script ranges
narrow the candidates: a word can only be in languages that use its script. Viterbi over the
words of a text, with a penalty for each switch, then labels spans; the language of a text
is the one that most of its letters are labelled with.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import ascii_words, slices, stage_for

ORDERS = (1, 2, 3)
BITS = 16
#: The fit looks at so many rows of each language at most (expected number, drawn by a hash).
MAX_ROWS_PER_LANGUAGE = 4_000
FIT_PARTS = 8
SMOOTHING = 0.5
#: Cost of a switch, and of a word in a script that a language does not use, in nats.
SWITCH = 12.0
FOREIGN_SCRIPT = 40.0
#: One word says no more than this, in nats, so that a single odd word makes no span.
MOST = 8.0
#: A language uses a script that at least this share of its letters is in.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"
PIECE = 4 << 20
# First code points of ranges, and the script of each.
SCRIPT_STARTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "other"), (0x0B80, "Tamil"), (0x0C00, "other"),
    (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"),
    (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"), (0x3100, "other"),
    (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "other"), (0x20000, "Han"), (0x323B0, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_STARTS))


def lowered_letters(points: np.ndarray) -> np.ndarray:
    """Code points of letters in lower case; 0 in place of everything else."""
    distinct, back = np.unique(points, return_inverse=True)
    out = np.zeros(len(distinct), dtype=np.uint32)
    for i, p in enumerate(distinct.tolist()):
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else p
    return out[back]


@dataclass(frozen=True)
class WordFeatures:
    """N-grams of distinct words: word and cell of each; letters and scripts of the words."""

    word: np.ndarray
    cell: np.ndarray
    letters: np.ndarray
    scripts: np.ndarray


def word_features(words: list[str]) -> WordFeatures:
    """N-grams within runs of letters, which begin and end with a boundary."""
    raw = np.frombuffer("\n".join(["", *words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.cumsum(raw == 10) - 1
    points = lowered_letters(raw)
    is_letter = points > 0
    owners, cells = [], []
    for n in ORDERS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        code = np.full(m, n, dtype=np.uint64)
        for k in range(n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + points[k : k + m]
            code ^= code >> np.uint64(31)
        # Not across words: all but the first and last place must be letters, and one of n.
        inner = np.ones(m, dtype=bool)
        for k in range(1, n - 1):
            inner &= is_letter[k : k + m]
        some = is_letter[:m] | is_letter[n - 1 : n - 1 + m]
        at = np.flatnonzero(inner & some)
        first = np.where(is_letter[at], at, at + n - 1)
        owners.append(owner[first])
        cells.append((code[at] * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS))
    starts = np.array([s for s, _ in SCRIPT_STARTS])
    names = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])
    at = np.flatnonzero(is_letter)
    script = names[np.searchsorted(starts, points[at], side="right") - 1]
    size = len(words) * len(SCRIPTS)
    scripts = np.bincount(owner[at] * len(SCRIPTS) + script, minlength=size)[:size]
    scripts = scripts.reshape(len(words), len(SCRIPTS))
    return WordFeatures(
        np.concatenate(owners).astype(np.int64), np.concatenate(cells).astype(np.int64),
        scripts.sum(axis=1), scripts,
    )


@dataclass(frozen=True)
class LanguageModel:
    """``logs``: log probability of each n-gram cell per language; ``uses``: scripts of each."""

    languages: tuple[str, ...]
    logs: np.ndarray
    uses: np.ndarray

    def word_scores(self, features: WordFeatures, n: int) -> np.ndarray:
        """Score of every word in every language, at most ``MOST`` below its best one."""
        out = np.empty((n, len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(features.word, self.logs[k][features.cell], minlength=n)[:n]
        script = features.scripts.argmax(axis=1)
        allowed = self.uses[:, script].T
        allowed[~allowed.any(axis=1)] = True
        best = np.where(allowed, out, -np.inf).max(axis=1, keepdims=True)
        out = np.maximum(out - best, -MOST)
        return np.where(allowed, out, -FOREIGN_SCRIPT)


def viterbi(scores: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            switch: float = SWITCH) -> np.ndarray:
    """Best language of every word of texts whose words are ``codes[start:end]``.

    All texts take a step at a time; the shorter ones drop out. Ties stay with the language of
    the neighbour, then with the lower number.
    """
    langs = scores.shape[1]
    labels = np.zeros(len(codes), dtype=np.int16)
    if langs == 1 or not len(codes):
        return labels
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, lengths = starts[order], lengths[order]
    alive = int((lengths > 0).sum())
    value = scores[codes[at[:alive]]].copy()
    came = np.zeros((len(codes), langs), dtype=bool)
    top = np.zeros(len(codes), dtype=np.int16)
    active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if alive else 0) + 1), side="right")
    for t in range(1, len(active)):
        m = int(active[t])
        place = at[:m] + t
        v = value[:m]
        best = v.argmax(axis=1)
        jump = v[np.arange(m), best] - switch
        jumped = jump[:, None] > v
        came[place] = jumped
        top[place] = best
        value[:m] = np.where(jumped, jump[:, None], v) + scores[codes[place]]
    state = value.argmax(axis=1) if alive else np.empty(0, np.int64)
    labels[at[:alive] + lengths[:alive] - 1] = state
    for t in range(len(active) - 1, 0, -1):
        m = int(active[t])
        place = at[:m] + t
        now = labels[place]
        labels[place - 1] = np.where(came[place, now], top[place], now)
    return labels


# --- fit --------------------------------------------------------------------------------


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            part = batch.filter(pa.array(langs == lang))
            for piece in slices(part, size=PIECE):
                _, flat = ascii_words(piece.column("text"))
                counted = pc.value_counts(flat)
                times = counted.field("counts").to_numpy()
                found = word_features(counted.field("values").to_pylist())
                own = np.bincount(found.cell, times[found.word], minlength=1 << BITS)
                sums[lang] = sums.get(lang, 0) + own
                scripts[lang] = scripts.get(lang, 0) + times @ found.scripts
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()),
         pa.array([zlib.compress(s.astype(np.int64).tobytes(), 1) for s in sums.values()], pa.binary()),
         pa.array([s.astype(np.int64).tobytes() for s in scripts.values()], pa.binary())],
        names=["lang", "cells", "scripts"],
    )


def fit_languages(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    max_rows: int = MAX_ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from rows with a text and a language; others are left out.

    Of a language with more than ``max_rows`` rows a part is drawn by a hash of the
    identifier. The tables of the model have a fixed number of cells for each language.
    """
    rows = labelled.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.lit("lang"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("draw"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    staging = stage_for(labelled.sparkSession)
    seen = staging.table(rows.groupBy("lang").agg(F.count("*").alias("n")), "seen")
    part = F.least(F.lit(1.0), F.lit(float(max_rows)) / F.col("n")) * (1 << 30)
    drawn = rows.join(seen, "lang").where(F.pmod("draw", F.lit(1 << 30)) < part)
    parts = drawn.select("lang", "text").repartition(FIT_PARTS).mapInArrow(
        _count_ngrams, "lang string, cells binary, scripts binary"
    )
    cells: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for lang, own, used in parts.toLocalIterator():
        cells[lang] = cells.get(lang, 0) + np.frombuffer(zlib.decompress(own), dtype=np.int64)
        scripts[lang] = scripts.get(lang, 0) + np.frombuffer(used, dtype=np.int64)
    staging.discard()
    # A language whose texts have no letter cannot be told from another.
    languages = tuple(sorted(lang for lang in cells if cells[lang].sum() > 0))
    if not languages:
        return LanguageModel((), np.zeros((0, 1 << BITS)), np.zeros((0, len(SCRIPTS)), bool))
    logs, uses = [], []
    for lang in languages:
        counts = cells[lang] + SMOOTHING
        logs.append(np.log(counts / counts.sum()))
        share = scripts[lang] / max(scripts[lang].sum(), 1)
        uses.append(share >= SCRIPT_SHARE)
    return LanguageModel(languages, np.array(logs), np.array(uses))


# --- labels -----------------------------------------------------------------------------

RESULT = (
    "doc_id long, lang_pred string, score double, "
    "spans array<struct<lang: string, first_word: int, words: int>>"
)
SPAN = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32())])


def _label(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*model.value)
        for batch in batches:
            for piece in slices(batch, size=PIECE):
                yield label_batch(piece, m)

    return run


def label_batch(piece: pa.RecordBatch, m: LanguageModel) -> pa.RecordBatch:
    n, langs = piece.num_rows, len(m.languages)
    rows, flat = ascii_words(piece.column("text"))
    coded = flat.dictionary_encode()
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy()
    share, best = np.zeros(n), np.zeros(n, dtype=np.int64)
    told = np.zeros(n, dtype=bool)
    spans: list[list[dict]] = [[] for _ in range(n)]
    if words and langs:
        found = word_features(words)
        lettered = found.letters[codes] > 0
        position = np.arange(len(codes)) - np.searchsorted(rows, rows)
        codes, rows, position = codes[lettered], rows[lettered], position[lettered]
        scores = m.word_scores(found, len(words))
        ends = np.searchsorted(rows, np.arange(n), side="right")
        starts = np.searchsorted(rows, np.arange(n), side="left")
        labels = viterbi(scores, codes, starts, ends)
        weight = np.bincount(
            rows * langs + labels, found.letters[codes], minlength=n * langs
        ).reshape(n, langs)
        best, total = weight.argmax(axis=1), weight.sum(axis=1)
        told = total > 0
        share = np.divide(weight.max(axis=1), total, out=np.zeros(n), where=told)
        new = np.ones(len(labels), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (labels[1:] != labels[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(labels)) - 1
        for a, b in zip(first.tolist(), last.tolist()):
            spans[rows[a]].append({
                "lang": m.languages[labels[a]], "first_word": int(position[a]),
                "words": int(position[b] - position[a] + 1),
            })
    names = [m.languages[b] if t else UNKNOWN for b, t in zip(best, told)]
    return pa.RecordBatch.from_arrays(
        [piece.column("doc_id"), pa.array(names, pa.string()), pa.array(share),
         pa.array(spans, pa.list_(SPAN))],
        names=["doc_id", "lang_pred", "score", "spans"],
    )


def identify_languages(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every row, in one pass without a shuffle.

    ``score`` is the share of the letters that are in spans of ``lang_pred``. Spans count words
    between ASCII white space from 0; words without a letter belong to no span, or to the one
    around them. A text that is null or has no letter, and every text where nothing was
    learned, is ``und`` with score 0. Ties go to the first language by name. Null and repeated
    identifiers are rows like others.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.logs, model.uses))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_label(sent), RESULT)
