"""Fuzzy line dedup.

Lines are normalised and get a 64-bit SimHash of their words. Lines whose SimHashes differ in
few bits agree on some of the blocks that the 64 bits are cut into (pigeonhole), so those
blocks are join keys. Pairs that are close enough are verified by edit similarity, and of
each connected group of lines one occurrence stays in the corpus.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import ascii_lower, row_hash, shuffle_parts, stage_for, thinned
from docquay.llm.components import components
from docquay.sources.staging import Staging

#: SimHashes may differ in so many bits.
BITS_APART = 3
#: The 64 bits are cut into blocks; with 5 blocks, 2 are equal if 3 bits or fewer differ.
BLOCKS = 5
#: One minus edit distance over the longer length, in words of normalised lines.
SIMILARITY = 0.85
#: Between words of a lowered line: ASCII without digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Code points that stand for words when two lines are compared: none of them is special.
FIRST_POINT, POINTS = 0x100, 55_000
DOC = ["doc_id", "row_hash"]
LINE = [*DOC, "copy", "position", "line", "words"]
#: A word begins here, in a lowered line.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Words that are counted at once: as many as six binary digits can tell.
CHUNK, DIGITS = 63, 6
#: Counters of 16 bits, four in a signed number; a part of a line has fewer words than they hold.
PART_CHUNKS = 260
_FIELD = 0x0001000100010001
#: Lines with the same key are compared with each other up to so many; more are all looked at later.
GROUP = 1000


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, BETWEEN), "")


def text_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_hash, copy, position, words`` of every line with a word.

    Lines end with a line feed. Normalised, a line is its words: A-Z lowered, runs of ASCII
    letters, digits and characters outside ASCII. ``copy`` tells repeated rows apart while
    their words are counted, and nowhere else.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_hash(F.col(text_col)).alias("row_hash"),
        F.monotonically_increasing_id().alias("copy"), ascii_lower(F.col(text_col)).alias("text"),
    )
    rows = rows.select(*DOC, "copy", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    rows = rows.where(F.col("line").rlike(WORD))
    return rows.select(*DOC, "copy", "position", _words(F.col("line")).alias("words"))


def _simhash(sums: list[Column], words: Column) -> Column:
    """Bits that more than half of the words have set, from counts of a part's words.

    A count plus ``0x3FFF`` less half of the words reaches ``0x4000`` if it is more than half, and
    stays below ``0x8000``, so the four counts of a number do not meet.
    """
    rest = (F.lit(0x3FFF) - F.shiftright(words, 1)).cast("long") * F.lit(_FIELD)
    bits = [
        F.shiftleft(F.shiftrightunsigned(packed + rest, 14).bitwiseAND(F.lit(_FIELD)), k)
        for k, packed in enumerate(sums)
    ]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def _majority(digits: list[Column], words: Column) -> Column:
    """Bits whose count, in binary ``digits`` from the lowest up, is more than half of ``words``."""
    half, more = F.shiftright(words, 1), F.lit(0).cast("long")
    for k, digit in enumerate(digits):
        wanted = -F.shiftright(half, k).bitwiseAND(F.lit(1)).cast("long")
        above = digit.bitwiseAND(F.bitwise_not(wanted))
        more = above.bitwiseOR(F.bitwise_not(digit.bitwiseXOR(wanted)).bitwiseAND(more))
    return more


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``d0`` to ``d5`` for ``hashes``, ``CHUNK`` numbers at most: at each bit, the
    count of those that have it set, in binary.

    Three numbers of one weight become their sum and carries (a full adder for all 64 bits at
    once) until one number of each weight is left.
    """
    keep = [c for c in rows.columns if c != "hashes"]
    columns = {0: [F.coalesce(F.get("hashes", F.lit(k)), F.lit(0).cast("long")) for k in range(CHUNK)]}
    while any(len(c) > 1 for c in columns.values()):
        after: dict[int, list[Column]] = {}
        for weight, waiting in columns.items():
            full = len(waiting) // 3 * 3
            for a, b, c in zip(waiting[:full:3], waiting[1:full:3], waiting[2:full:3]):
                odd = a.bitwiseXOR(b)
                after.setdefault(weight, []).append(odd.bitwiseXOR(c))
                after.setdefault(weight + 1, []).append(a.bitwiseAND(b).bitwiseOR(odd.bitwiseAND(c)))
            after.setdefault(weight, []).extend(waiting[full:])
        named = {w: [(f"d{w}_{k}", c) for k, c in enumerate(cs)] for w, cs in after.items()}
        rows = rows.select(*keep, *[c.alias(n) for cs in named.values() for n, c in cs])
        columns = {w: [F.col(n) for n, _ in cs] for w, cs in named.items()}
    return rows.select(*keep, *[columns[w][0].alias(f"d{w}") for w in range(DIGITS)])


def line_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines with their SimHash, and pieces of lines of more than ``CHUNK`` words with binary counts.

    Pieces have ``d0`` to ``d5`` and no ``simhash`` yet; the others have no ``copy``, ``at`` and counts.
    """
    rows = text_lines(docs, id_col, text_col).select(
        *DOC, "copy", "position", F.xxhash64("words").alias("line"), F.size("words").alias("words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    # Only its own hashes go with a piece, so a very long line is not repeated.
    pieces = F.transform(
        F.sequence(F.lit(1), "words", F.lit(CHUNK)),
        lambda at: F.struct(at.alias("at"), F.slice("hashes", at, F.lit(CHUNK)).alias("hashes")),
    )
    rows = rows.select(*LINE, F.explode(pieces).alias("piece")).select(*LINE, "piece.*")
    rows = _counted(rows)
    digits, several = [F.col(f"d{k}") for k in range(DIGITS)], F.col("words") > CHUNK
    return rows.select(
        *DOC, "position", "line", "words",
        F.when(~several, _majority(digits, F.col("words"))).alias("simhash"),
        *[F.when(several, F.col(c)).alias(c) for c in ("copy", "at")],
        *[F.when(several, d).alias(f"d{k}") for k, d in enumerate(digits)],
    )


def long_lines(chunks: DataFrame) -> DataFrame:
    """``doc_id, row_hash, position, line, words, simhash`` of the lines that ``chunks`` has in pieces."""
    def packed(k: int) -> Column:
        """Counts of the bits ``k``, ``k + 16``, ... in one number."""
        fields = [
            F.shiftleft(F.shiftrightunsigned(f"d{j}", k).bitwiseAND(F.lit(_FIELD)), j) for j in range(DIGITS)
        ]
        return reduce(lambda x, y: x.bitwiseOR(y), fields)

    sums = [F.col(f"s{k}") for k in range(16)]
    digits = [F.coalesce(f"d{j}", F.lit(0).cast("long")).alias(f"d{j}") for j in range(DIGITS)]
    part = F.floor(F.col("at") / (CHUNK * PART_CHUNKS)).alias("part")
    pieces = chunks.where(F.col("words") > CHUNK).select(*LINE, part, *digits)
    pieces = pieces.select(*LINE, "part", *[packed(k).alias(f"s{k}") for k in range(16)])
    parts = pieces.groupBy(*LINE, "part").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(16)])
    one = F.col("words") <= CHUNK * PART_CHUNKS
    short = parts.where(one).select(
        *DOC, "position", "line", "words", _simhash(sums, F.col("words")).alias("simhash")
    )
    # Very long lines: one row per bit and part, summed apart.
    bits = F.explode(F.array(*[
        F.struct(
            F.lit(16 * j + k).alias("bit"),
            F.shiftrightunsigned(sums[k], 16 * j).bitwiseAND(F.lit(0xFFFF)).alias("count"),
        )
        for k in range(16) for j in range(4)
    ]))
    long = parts.where(~one).select(*LINE, bits.alias("b"))
    long = long.groupBy(*LINE, "b.bit").agg(F.sum("b.count").alias("count"))
    value = F.when(F.col("count") * 2 > F.col("words"), F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0).cast("long"))
    long = long.groupBy(*LINE).agg(F.bit_or(value).alias("simhash")).drop("copy")
    return short.unionByName(long)


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_hash, position, line, words, simhash`` of every line with a word.

    ``line`` is the hash that stands for the normalised line, ``words`` their number. A line of
    up to ``CHUNK`` words is counted where it is read; only pieces of longer ones are summed.
    """
    chunks = line_chunks(docs, id_col, text_col)
    return _short_lines(chunks).unionByName(long_lines(chunks))


def _short_lines(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("words") <= CHUNK).select(*DOC, "position", "line", "words", "simhash")


def block_masks(apart: int = BITS_APART, blocks: int = BLOCKS) -> list[int]:
    """The bits of each choice of ``blocks - apart`` blocks, as signed numbers."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - apart):
        mask = sum(((1 << (cuts[c + 1] - cuts[c])) - 1) << cuts[c] for c in chosen)
        masks.append(mask - ((1 << 64) if mask >> 63 else 0))
    return masks


def block_keys(simhash: Column, apart: int = BITS_APART, blocks: int = BLOCKS) -> list[Column]:
    """One key for each choice of ``blocks - apart`` blocks; lines within reach share one."""
    return [
        F.xxhash64(F.lit(n), simhash.bitwiseAND(F.lit(mask).cast("long")))
        for n, mask in enumerate(block_masks(apart, blocks))
    ]


def _bits_near(a: Column, b: Column, apart: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= apart


def near_hashes(
    hashed: DataFrame, staging: Staging, apart: int = BITS_APART, blocks: int = BLOCKS, group: int = GROUP
) -> DataFrame:
    """``simhash`` of all that several rows have, or that is within ``apart`` bits of another one.

    Nothing else can be linked or repeated. Of a line only its SimHash moves, once for each key.
    Keys of more than ``group`` different SimHashes are not looked into and give all of theirs.
    """
    counts = hashed.groupBy("simhash").agg(F.count("*").alias("n"))
    counts = staging.table(counts, "counts").where("simhash is not null")
    masks = [F.lit(m).cast("long") for m in block_masks(apart, blocks)]
    choice = F.explode(F.array(*[F.lit(k) for k in range(len(masks))])).alias("k")
    key = F.xxhash64("k", F.col("simhash").bitwiseAND(F.get(F.array(*masks), F.col("k"))))
    rows = counts.select(choice, "simhash").repartition(shuffle_parts(hashed.sparkSession), key)
    rows = rows.select(key.alias("key"), "simhash")
    sizes = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.min("simhash").alias("low"), F.max("simhash").alias("high")
    )
    company = (F.col("n") > 2) | ((F.col("n") == 2) & _bits_near(F.col("low"), F.col("high"), apart))
    few = sizes.where(company & (F.col("n") <= group)).select("key").hint("merge")
    other = rows.withColumnRenamed("simhash", "other").hint("merge")
    pairs = rows.join(few, "key").join(other, "key").where(
        (F.col("simhash") < F.col("other")) & _bits_near(F.col("simhash"), F.col("other"), apart)
    )
    pairs = pairs.select(F.explode(F.array("simhash", "other")).alias("simhash"))
    crowd = thinned(rows, sizes.where(F.col("n") > group), "key").select("simhash")
    return counts.where("n > 1").select("simhash").union(crowd).union(pairs).distinct()


def shared_keys(lines: DataFrame, apart: int = BITS_APART, blocks: int = BLOCKS) -> DataFrame:
    """``key, line, simhash, words`` for each block key that a line of ``lines`` shares with others."""
    keys = F.explode(F.array(*block_keys(F.col("simhash"), apart, blocks)))
    rows = lines.select(keys.alias("key"), "line", "simhash", "words")
    several = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return rows.join(several, "key")


def _near(a: str, b: str, apart: int, similarity: float) -> Column:
    """Two lines whose SimHashes are close and whose lengths allow the similarity."""
    bits = _bits_near(F.col(f"{a}.simhash"), F.col(f"{b}.simhash"), apart)
    low, high = F.least(f"{a}.words", f"{b}.words"), F.greatest(f"{a}.words", f"{b}.words")
    return bits & (low >= high * similarity)


def leader_pairs(keyed: DataFrame, apart: int, similarity: float) -> DataFrame:
    """``line_a, line_b, words_a, words_b``: close lines, of each key the first line and another.

    However many lines a key has, each is in one pair at most, and a group of near copies is
    connected through its first line.
    """
    leaders = keyed.groupBy("key").agg(F.min(F.struct("line", "simhash", "words")).alias("a"))
    stars = keyed.select("key", F.struct("line", "simhash", "words").alias("b")).join(leaders, "key")
    stars = stars.where((F.col("a.line") < F.col("b.line")) & _near("a", "b", apart, similarity))
    return _as_pairs(stars)


def open_pairs(keyed: DataFrame, groups: DataFrame, apart: int, similarity: float) -> DataFrame:
    """The other close pairs of a key, as far as ``groups(node, component)`` has not connected them."""
    named = keyed.join(groups.withColumnRenamed("node", "line"), "line", "left").select(
        "key", F.coalesce("component", "line").alias("component"), "line", "simhash", "words"
    )
    apart_still = named.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("key")
    side = F.struct("line", "simhash", "words", "component")
    left = named.join(apart_still, "key").select("key", side.alias("a"))
    right = left.select("key", F.col("a").alias("b"))
    other = (F.col("a.line") < F.col("b.line")) & (F.col("a.component") != F.col("b.component"))
    return _as_pairs(left.join(right, "key").where(other & _near("a", "b", apart, similarity)))


def _as_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("a.line").alias("line_a"), F.col("b.line").alias("line_b"),
        F.col("a.words").alias("words_a"), F.col("b.words").alias("words_b"),
    ).distinct()


def word_points(words: Column) -> Column:
    """A text with one character for each word, by a hash; its edit distance is that in words."""
    def point(word: Column) -> Column:
        code = F.pmod(F.xxhash64(word), F.lit(POINTS)) + FIRST_POINT
        return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")

    return F.array_join(F.transform(words, point), "")


def line_texts(
    docs: DataFrame, distinct: DataFrame, wanted: DataFrame, staging: Staging, id_col: str, text_col: str
) -> DataFrame:
    """``line, points`` of the ``wanted(line)``: a character for each word.

    ``distinct`` knows one place of each line. Only texts that may have a wanted place are cut into
    lines once more, and only what stands there is lowered, cut into words and moved.
    """
    place = F.xxhash64(*DOC, "position").alias("place")
    first = wanted.join(distinct, "line").select("line", "first.*").select("*", place)
    first = staging.table(first, "first")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_hash(F.col(text_col)).alias("row_hash"),
        F.col(text_col).alias("text"),
    )
    rows = thinned(rows, first, "row_hash").select(*DOC, F.posexplode(F.split("text", "\n")).alias("position", "raw"))
    there = thinned(rows.select("*", place), first, "place").alias("l")
    at = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*DOC, "position"]]
    texts = there.join(first.drop("place").alias("r"), at).select(
        "r.line", word_points(_words(ascii_lower(F.col("l.raw")))).alias("points")
    )
    # Repeated rows give the same line again.
    texts = staging.table(texts.dropDuplicates(["line"]), "texts")
    staging.drop("first")
    return texts


def similar_lines(pairs: DataFrame, texts: DataFrame, staging: Staging, name: str, similarity: float) -> DataFrame:
    """``a, b`` of those pairs of lines whose edit similarity is high enough."""
    most = F.floor((1.0 - similarity) * F.greatest("words_a", "words_b")).cast("int")
    compared = (
        pairs.join(texts.select(F.col("line").alias("line_a"), F.col("points").alias("x")), "line_a")
        .join(texts.select(F.col("line").alias("line_b"), F.col("points").alias("y")), "line_b")
        .withColumn("most", most)
    )
    # Stops as soon as the distance is over ``most``, and is negative then.
    distance = F.expr("levenshtein(x, y, most)")
    edges = compared.where(distance >= 0).select(
        F.col("line_a").alias("a"), F.col("line_b").alias("b")
    )
    return staging.table(edges, f"{name}-edges")


def line_groups(
    docs: DataFrame, staging: Staging, id_col: str, text_col: str,
    apart: int = BITS_APART, blocks: int = BLOCKS, similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, row_hash, position, keep_*`` of every line that is not the one that stays.

    Lines of a key are compared with its first line, and the links found are connected. Then
    all pairs of a key are looked at that are not connected yet, so no group is lost.
    """
    chunks = staging.table(line_chunks(docs, id_col, text_col), "chunks")
    long = staging.table(long_lines(chunks), "long")
    hashed = _short_lines(chunks).unionByName(long)
    # All others are the only line of their group.
    near = staging.table(near_hashes(hashed, staging, apart, blocks), "near")
    mark = F.xxhash64("simhash").alias("mark")
    hashed = thinned(hashed.select("*", mark), near.select(mark), "mark").join(near, "simhash", "left_semi")
    hashed = staging.table(hashed.select(*DOC, "position", "line", "words", "simhash"), "hashed")
    for done in ("chunks", "long", "counts", "near"):
        staging.drop(done)
    place = F.struct("doc_id", "row_hash", "position")
    distinct = hashed.groupBy("line").agg(
        F.min("simhash").alias("simhash"), F.min("words").alias("words"),
        F.min(place).alias("first"), F.count("*").alias("times"),
    )
    distinct = staging.table(distinct, "distinct")
    keyed = staging.table(shared_keys(distinct, apart, blocks), "keyed")

    texts = line_texts(docs, distinct, keyed.select("line").distinct(), staging, id_col, text_col)

    def similar(pairs: DataFrame, name: str) -> DataFrame:
        return similar_lines(pairs, texts, staging, name, similarity)

    stars = similar(leader_pairs(keyed, apart, similarity), "stars")
    groups = staging.table(components(stars, staging, "star-groups"), "connected")
    rest = similar(open_pairs(keyed, groups, apart, similarity), "rest")
    edges = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)
    grouped = components(edges, staging, "groups").withColumnRenamed("node", "line")
    named = distinct.join(grouped, "line", "left").withColumn(
        "component", F.coalesce("component", "line")
    )
    keeps = named.groupBy("component").agg(F.min("first").alias("keep"), F.sum("times").alias("n"))
    crowded = named.join(keeps.where("n > 1"), "component").select("line", "keep")
    occurrences = hashed.join(crowded, "line").select(*DOC, "position", "keep")
    here = F.struct(*DOC, "position")
    return occurrences.where(~here.eqNullSafe(F.col("keep")))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    apart: int = BITS_APART, blocks: int = BLOCKS, similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of every row, with repeated lines removed.

    Lines are linked if they are equal once normalised, or if their SimHashes differ in at most
    ``apart`` bits and their edit similarity, in words, is at least ``similarity``. Of a connected group
    the first occurrence stays, by identifier (null first), text hash and position. Lines without
    a word always stay. A null text stays null, with no lines. Repeated rows count as one document and get the same
    result; rows that share an identifier only are documents of their own. An empty table gives
    an empty result.
    """
    staging = stage_for(docs.sparkSession)
    removed = line_groups(docs, staging, id_col, text_col, apart, blocks, similarity)
    # As many numbers as the document has lines, at most.
    places = removed.groupBy(*DOC).agg(F.collect_set("position").alias("places"))
    places = staging.table(places, "places")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_hash(F.col(text_col)).alias("row_hash"),
        F.col(text_col).alias("text"),
    )
    same = reduce(
        lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in DOC]
    )
    joined = rows.alias("l").join(places.alias("r"), same, "left").select("l.*", "r.places")
    numbered = F.split("text", "\n")
    gone = F.map_from_arrays("places", F.transform("places", lambda x: F.lit(True)))
    kept = F.filter(numbered, lambda line, i: F.col("gone")[i].isNull())
    return joined.withColumn("gone", gone).select(
        "doc_id",
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(numbered)).cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.size("places")).cast("long").alias("n_removed"),
        F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )
