"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source documents are sorted by that key
(ranges of the key are sorted apart, and the totals of the ranges are summed ahead), and a
distributed prefix sum of their sizes tells where the budget of the source ends. A source
whose budget exceeds its size is taken in whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docquay.llm.common import running_sum, shuffle_parts, stage_for

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
#: Ranges of the hash key that a source is cut into, for each shuffle partition.
RANGES_PER_PARTITION = 4


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
) -> DataFrame:
    """``source, source_size, target`` from one row ``source, source_size`` per source.

    Sources by code point, null last, get ``weights`` in turn. Together they get ``share``
    of all sizes, by weight; none gets more than ``epochs`` times its size, and what a
    full source leaves goes to the others by weight. That is filling by one level L:
    target = min(limit, L * weight). Sources sorted by limit / weight are full from the
    front, so prefix sums of limits and weights give L without repeated rounds.
    """
    everything = W.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    rows = sizes.select(
        "source", "source_size", weight.alias("weight"),
        (F.col("source_size") * F.lit(float(epochs))).alias("limit"),
    )
    by_ratio = everything.orderBy(
        F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source")
    )
    fill = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))
    spent = F.coalesce(F.sum("limit").over(fill), F.lit(0.0))
    rows = rows.select(
        "*", ((total - spent) / rest).alias("level"), F.row_number().over(by_ratio).alias("turn")
    )
    # The first source, in that order, that the level does not fill ends the search.
    not_full = F.col("level") * F.col("weight") < F.col("limit")
    level = F.min_by(F.when(not_full, F.col("level")), F.when(not_full, F.col("turn")))
    level = level.over(everything)
    target = F.when(level.isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), level * F.col("weight"))
    )
    return rows.select("source", "source_size", F.round(target, 6).alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = "",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, epoch_count, taken`` for every row.

    ``taken`` is the number of words the mix takes from the document, repeats counted:
    ``epoch_count`` whole passes and what the budget leaves of one more. Per source they
    add up to the whole part of its target; only one document of a source is cut. A null text
    has size 0 and nothing is taken from it. Null sources are one source. Null and
    repeated identifiers are rows like others. Keys depend on ``seed`` and identifier
    alone, so a rerun takes the same words.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    ).withColumn("key", key)
    ranges = RANGES_PER_PARTITION * shuffle_parts(spark)
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("range", F.floor(place * ranges / F.lit(1 << 32)).cast("int"))
    rows = stage_for(spark).table(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = running_sum(rows, ["source"], "range", ["key", "doc_id", "size"], "size", "ahead")
    targets = source_targets(sizes, weights, share, epochs)
    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    joined = rows.alias("l").join(targets.alias("r"), same).select(
        "l.*", "r.source_size", "r.target"
    )
    budget = F.floor("target")
    passes = F.when(
        F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))
    ).otherwise(F.lit(0)).cast("long")
    left = budget - F.col("epoch_count") * F.col("source_size") - F.col("ahead")
    more = F.least(F.col("size"), F.greatest(left, F.lit(0)))
    return joined.withColumn("epoch_count", passes).select(
        "doc_id", "source", "size", "source_size", "target", "epoch_count",
        (F.col("epoch_count") * F.col("size") + more).cast("long").alias("taken"),
    )
