"""Benchmark decontamination: a positional inverted index of the training texts.

Test items are cut into windows of consecutive words. Occurrences of the test terms are
counted over all training tokens; for every window the two rarest terms are the lists to
start from. Their postings (term, document, position) are stored; positions minus the
offsets of the terms are intersected, and the few places that survive are intersected with
the postings of all other terms of the window. What remains are exact phrase matches.
Letting the second list be off by a few words gives proximity matches.

The tokens of the training texts are never shuffled as long as the list of test terms is
below the session's broadcast threshold, which Spark checks against the size of the
written table; beyond it the same joins run by sort and merge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docquay.llm.common import ascii_lower, stage_for

WINDOW = 10
SLOP = 2
#: Everything between two words of lowered text: ASCII without digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOC = ["doc_id", "row_hash"]


def word_array(text: Column) -> Column:
    """Words of a text, A-Z lowered; null has none."""
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows under (identifier, hash of text), so rows that share an identifier stay apart."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row_hash"),
        F.col(text_col).alias("text"),
    )


def _tokens(rows: DataFrame) -> DataFrame:
    return rows.select(*DOC, F.posexplode(word_array(F.col("text"))).alias("position", "term"))


def _same(columns: list[str]) -> list[Column]:
    return [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns]


def item_windows(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``win, terms`` and their items ``win, item_id``.

    An item of fewer than ``window`` words is one window; one without words has none.
    """
    rows = items.select(
        F.col(id_col).alias("item_id"), word_array(F.col(text_col)).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = rows.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.slice("words", F.col("start"), window).alias("terms")
    )
    cut = cut.withColumn("win", F.sha2(F.array_join("terms", " "), 256))
    return cut.select("win", "terms").dropDuplicates(["win"]), cut.select("win", "item_id").distinct()


@dataclass(frozen=True)
class Matches:
    """``phrase``: document, win, start, length. ``near``: document, win, start."""

    phrase: DataFrame
    near: DataFrame


def find_matches(
    docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    slop: int = SLOP,
) -> Matches:
    """Places of ``windows(win, terms)`` in the training texts.

    ``phrase`` has every place where all terms of a window follow one another. ``near``
    has the places where its rarest term stands and the second rarest is at most ``slop``
    words off its place, among the terms that occur at all; phrases of more than one distinct
    term are among them.
    """
    staging = stage_for(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col)
    windows = staging.table(windows, "windows")
    spots = windows.select(
        "win", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term")
    )
    spots = staging.table(spots, "spots")
    terms = staging.table(spots.select("term").distinct().coalesce(1), "terms")

    seen = _tokens(rows).join(terms, "term").groupBy("term").agg(F.count("*").alias("seen"))
    seen = staging.table(seen.coalesce(1), "seen")
    rarest = W.partitionBy("win").orderBy(F.col("seen").asc_nulls_last(), "term", "offset")
    # One offset per term of a window; with a term that no text has it can only be near.
    ranked = (
        spots.groupBy("win", "length", "term").agg(F.min("offset").alias("offset"))
        .join(seen, "term", "left").withColumn("rank", F.row_number().over(rarest))
        .withColumn("possible", F.count("seen").over(W.partitionBy("win")) == F.count("*").over(W.partitionBy("win")))
        .where("seen is not null and rank <= 2")
    )
    seeds = staging.table(ranked.select("win", "length", "term", "offset", "rank", "possible").coalesce(1), "seeds")
    first, second = seeds.where("rank = 1").drop("rank"), seeds.where("rank = 2").drop("rank")

    listed = staging.table(seeds.select("term").distinct().coalesce(1), "listed")
    postings = staging.table(_tokens(rows).join(listed, "term").distinct(), "postings")

    starts = postings.join(first, "term").where(F.col("position") >= F.col("offset")).select(
        *DOC, "win", "length", (F.col("position") - F.col("offset")).alias("start"), "possible"
    )
    # The second list, where a window has two distinct terms, with its places shifted by up to slop.
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    expected = starts.join(second.select("win", "term", "offset"), "win").withColumn("shift", shifts)
    expected = expected.withColumn("position", F.col("start") + F.col("offset") + F.col("shift"))
    paired = expected.alias("l").join(
        postings.alias("r"), _same([*DOC, "term", "position"])
    ).select(*[f"l.{c}" for c in [*DOC, "win", "length", "start", "shift", "possible"]])
    paired = staging.table(paired, "paired")
    alone = starts.where("possible").join(second.select("win"), "win", "left_anti").select(
        *DOC, "win", "length", "start"
    )
    exact = paired.where("possible and shift = 0").drop("shift", "possible").unionByName(alone)
    exact = staging.table(exact, "exact")

    # All other terms, in the documents that still matter: every offset must be found.
    alive = staging.table(exact.select(*DOC).distinct(), "alive")
    rest = rows.alias("l").join(alive.alias("r"), _same(DOC), "left_semi")
    rest = _tokens(rest).join(terms, "term").distinct()
    needed = exact.join(spots.select("win", "offset", "term"), "win").withColumn(
        "position", F.col("start") + F.col("offset")
    )
    phrase = (
        needed.alias("l").join(rest.alias("r"), _same([*DOC, "term", "position"]))
        .select("l.*").groupBy(*DOC, "win", "length", "start")
        .agg(F.count("*").alias("found")).where(F.col("found") == F.col("length")).drop("found")
    )
    phrase = staging.table(phrase, "phrase")
    return Matches(phrase, paired.select(*DOC, "win", "start").distinct())


def covered_words(phrase: DataFrame) -> DataFrame:
    """``doc_id, row_hash, n_hit``: words inside any place, each counted once."""
    runs = phrase.groupBy(*DOC, "start").agg(F.max("length").alias("length"))
    end = F.col("start") + F.col("length")
    before = W.partitionBy(*DOC).orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = F.greatest(end - F.greatest(F.col("start"), reached), F.lit(0))
    return runs.withColumn("fresh", fresh).groupBy(*DOC).agg(F.sum("fresh").alias("n_hit"))


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, slop: int = SLOP,
) -> DataFrame:
    """``doc_id, row_hash, n_words, n_hit, n_items, items_sha256, contaminated, n_near`` of every row.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the items with
    one; ``items_sha256`` is the digest of their identifiers, sorted as strings and joined by
    commas (of the empty string if none). ``n_near`` counts the items that have a window within
    proximity. Null and empty texts have no words. Items with a null identifier are not
    counted or listed, but their words are hits. Rows that share an identifier are judged apart
    by their texts. Without items, or without documents, nothing is hit.
    """
    windows, owners = item_windows(items, item_id_col, item_text_col, window)
    owners = stage_for(docs.sparkSession).table(owners, "owners")
    matches = find_matches(docs, windows, id_col, text_col, slop)
    hits = covered_words(matches.phrase)
    ids = F.collect_set(F.col("item_id").cast("string"))
    found = (
        matches.phrase.select(*DOC, "win").distinct().join(owners, "win")
        .groupBy(*DOC).agg(F.array_sort(ids).alias("ids"))
    )
    near = (
        matches.near.select(*DOC, "win").distinct().join(owners, "win")
        .groupBy(*DOC).agg(F.count_distinct("item_id").alias("n_near"))
    )
    facts = hits.alias("l").join(found.alias("r"), _same(DOC), "left").select("l.*", "r.ids")
    facts = near.alias("r").join(facts.alias("l"), _same(DOC), "full").select(
        *[F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in DOC], "l.n_hit", "l.ids", "r.n_near"
    )
    rows = _keyed(docs, id_col, text_col).select(
        *DOC, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words")
    )
    ids = F.coalesce("r.ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("r.n_hit", F.lit(0)).cast("long")
    return rows.alias("l").join(facts.alias("r"), _same(DOC), "left").select(
        "l.doc_id", "l.row_hash", "l.n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("r.n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def keep_clean(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` in which no window of ``items`` occurs, with all their columns."""
    windows, _ = item_windows(items, window=window)
    hit = find_matches(docs, windows, id_col, text_col).phrase.select(*DOC).distinct()
    hit = stage_for(docs.sparkSession).table(hit, "hit")
    own = [
        F.col(f"l.{id_col}").eqNullSafe(F.col("r.doc_id")),
        F.xxhash64(F.coalesce(F.col(f"l.{text_col}"), F.lit(""))) == F.col("r.row_hash"),
    ]
    return docs.alias("l").join(hit.alias("r"), own, "left_anti")
