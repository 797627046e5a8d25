"""Personal data: patterned identifiers, and others that stand in the same contexts.

Addresses, numbers and the like that a pattern describes are the seeds. The words around
seeds make lexical patterns; a pattern that nearly only holds known identifiers of one kind
names the unknown ones in its place, which then vouch for further patterns. Patterns and
instances form a graph of distinct pairs that is scored in rounds of aggregates and joins.

Everything is an expression of DataFrames; texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import row_hash, stage_for
from docquay.sources.staging import Staging

# --- fixed values: kinds in their order, and what they look like ----------------
KINDS = ("email", "ip", "card", "phone")
#: Possessive, and started only where a run begins or the last match ended: never quadratic.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be searched at all.
MARKS = {"email": "@", "ip": ".", "phone": "+"}
UP_TO_255 = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)(?:\.|$)){4}$"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
# -------------------------------------------------------------------------------

#: A token that may be an identifier: it has an at sign or so many digits.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
TOKEN_DIGITS = 4
#: Characters on either side that context words are taken from.
CONTEXT = 64
#: Share of known instances that a pattern needs, out of its instances and one more.
PATTERN_SCORE = 0.8
#: Confidence, over all its patterns, at which an instance counts as known.
INSTANCE_SCORE = 0.8
ROUNDS = 4
#: Parts that the rows of one pattern or instance are spread over in joins.
SALTS = 16
#: Array elements that are summed one by one.
BLOCK = 128


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits, every second one from the right doubled, add up to a multiple of ten."""

    def weighed(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    weights = F.transform(F.split(F.reverse(digits), ""), weighed)
    return F.aggregate(weights, F.lit(0), lambda total, d: total + d) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    """What a match must be besides: parts up to 255, a number of digits, a check digit."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(UP_TO_255)
    digits = only_digits(value)
    if kind == "phone":
        return F.char_length(digits).between(*PHONE_DIGITS)
    return F.when(F.char_length(digits).between(*CARD_DIGITS), luhn(digits)).otherwise(False)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def with_matches(df: DataFrame, kind_patterns: dict[str, Column], text: str) -> DataFrame:
    """Per name the matches of a pattern in ``text``: ``start, end, value, left, right``, in order.

    ``kind_patterns`` holds the column of found strings. Offsets are sums of the lengths of what lies
    between matches; they are taken by blocks, so that many matches in one text cost no square.
    """
    names = list(kind_patterns)
    some = {k: F.size(f"__found_{k}") > 0 for k in names}
    df = df.withColumns({f"__found_{k}": found for k, found in kind_patterns.items()})
    df = df.withColumns({
        f"__pieces_{k}": F.when(some[k], F.split(text, TOKEN if k == "token" else PATTERNS[k], -1)) for k in names
    })
    df = df.withColumns({
        f"__sizes_{k}": F.zip_with(
            f"__pieces_{k}", f"__found_{k}",
            lambda piece, found: F.char_length(piece) + F.coalesce(F.char_length(found), F.lit(0)),
        ) for k in names
    })

    def sums(k: str) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(f"__sizes_{k}") / BLOCK).cast("int"))
        return F.transform(blocks, lambda b: _total(F.slice(f"__sizes_{k}", b * BLOCK + 1, F.lit(BLOCK))))

    df = df.withColumns({f"__sums_{k}": F.when(some[k], sums(k)) for k in names})

    def ahead(k: str) -> Column:
        return F.transform(f"__sums_{k}", lambda _, b: _total(F.slice(f"__sums_{k}", F.lit(1), b)))

    df = df.withColumns({f"__ahead_{k}": ahead(k) for k in names})

    def spans(k: str) -> Column:
        def span(value: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            within = _total(F.slice(f"__sizes_{k}", block * BLOCK + 1, i % BLOCK))
            left, right = F.get(f"__pieces_{k}", i), F.get(f"__pieces_{k}", i + 1)
            start = F.get(f"__ahead_{k}", block) + within + F.char_length(left)
            return F.struct(
                start.alias("start"), (start + F.char_length(value)).alias("end"), value.alias("value"),
                F.substring(left, -CONTEXT, CONTEXT).alias("left"),
                F.substring(right, 1, CONTEXT).alias("right"),
            )

        return F.transform(f"__found_{k}", span)

    df = df.withColumns({k: F.when(some[k], spans(k)) for k in names})
    return df.drop(*[f"__{c}_{k}" for c in ("found", "pieces", "sizes", "sums", "ahead") for k in names])


def overlaps(kind: str, span: Column) -> Column:
    """Whether a span meets one of the spans in column ``kind``, which are in order and apart.

    Halving finds the last one that begins before the span ends.
    """

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        right = F.get(kind, middle)["start"] < span["end"]
        return F.struct(
            F.when((at["low"] < at["high"]) & right, middle + 1).otherwise(at["low"]).alias("low"),
            F.when((at["low"] < at["high"]) & ~right, middle).otherwise(at["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(kind))))
    begin = F.struct(F.lit(0).alias("low"), F.size(kind).alias("high"))
    before = F.aggregate(steps, begin, halve)["low"] - 1
    return F.when(F.size(kind) > 0, F.coalesce(F.get(kind, before)["end"] > span["start"], F.lit(False))).otherwise(False)


def _words(context: Column) -> Column:
    """Context words in lower case, every digit as 0."""
    plain = F.translate(F.lower(context), "123456789", "000000000")
    return F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _use(start: Column, end: Column, value: Column, left: Column, right: Column, kind: Column) -> Column:
    """One place of an instance, with the two patterns it stands in."""
    before, after = _words(left), _words(right)
    edge = F.lit("^")
    last = F.coalesce(F.get(before, F.size(before) - 1), edge)
    last_but_one = F.coalesce(F.get(before, F.size(before) - 2), edge)
    following = F.coalesce(F.get(after, F.lit(0)), edge)
    return F.struct(
        start.alias("start"), end.alias("end"), kind.cast("int").alias("kind"),
        F.md5(F.encode(F.lower(value), "utf-8")).alias("instance"),
        F.array(
            F.concat_ws(" ", last_but_one, last, F.lit("_")), F.concat_ws(" ", last, F.lit("_"), following)
        ).alias("patterns"),
    )


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row_hash, base, uses`` of every row; the one pass over texts.

    ``base`` has the valid matches of all kinds (``start, kind, end``, in this order), ``uses`` those and
    all other tokens that may be identifiers, with instance and context patterns.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), row_hash(F.col(text_col)).alias("row_hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
    )
    nothing = F.array().cast("array<string>")

    def found(kind: str) -> Column:
        all_ = F.regexp_extract_all("__text", F.lit(PATTERNS[kind]), F.lit(0))
        return F.when(F.contains("__text", F.lit(MARKS[kind])), all_).otherwise(nothing) if kind in MARKS else all_

    rows = with_matches(rows, {k: found(k) for k in KINDS}, "__text")

    def valid(kind: str) -> Column:
        return F.filter(kind, lambda m: is_valid(kind, m["value"]))

    rows = rows.withColumns({k: valid(k) for k in KINDS})
    none = F.array()
    rows = rows.withColumn("__tokens", F.filter(
        F.regexp_extract_all("__text", F.lit(TOKEN), F.lit(0)),
        lambda t: (F.char_length(only_digits(t)) >= TOKEN_DIGITS) | t.contains("@"),
    ))
    any_token = F.when(F.size("__tokens") > 0, F.regexp_extract_all("__text", F.lit(TOKEN), F.lit(0)))
    rows = with_matches(rows, {"token": F.coalesce(any_token, nothing)}, "__text").drop("__tokens", "__text")

    def base(kind: str) -> Column:
        number = F.lit(KINDS.index(kind))
        spans = F.transform(kind, lambda m: F.struct(m["start"].alias("start"), number.alias("kind"), m["end"].alias("end")))
        return F.coalesce(spans, none.cast("array<struct<start:int,kind:int,end:int>>"))

    rows = rows.withColumn("base", F.array_sort(F.concat(*[base(k) for k in KINDS])))

    def trimmed(t: Column) -> Column:
        """The token from its first to its last letter or digit, a sign before a number included."""
        inner = F.regexp_extract(t["value"], r"(?s)[\p{L}\p{N}+@](?:.*[\p{L}\p{N}])?", 0)
        start = t["start"] + F.instr(t["value"], inner) - 1
        return F.struct(
            start.alias("start"), (start + F.char_length(inner)).alias("end"), inner.alias("value"),
            t["left"].alias("left"), t["right"].alias("right"),
        )

    free = F.filter(
        F.transform("token", trimmed),
        lambda t: ((F.char_length(only_digits(t["value"])) >= TOKEN_DIGITS) | t["value"].contains("@"))
        & ~overlaps(KINDS[0], t) & ~overlaps(KINDS[1], t) & ~overlaps(KINDS[2], t) & ~overlaps(KINDS[3], t),
    )
    rows = rows.withColumn("token", free)

    def uses(name: str, kind: Column) -> Column:
        found_uses = F.transform(
            name, lambda m: _use(m["start"], m["end"], m["value"], m["left"], m["right"], kind))
        return F.coalesce(found_uses, none.cast("array<struct<start:int,end:int,kind:int,instance:string,patterns:array<string>>>"))

    every = [uses(k, F.lit(n)) for n, k in enumerate(KINDS)] + [uses("token", F.lit(None))]
    return rows.select("doc_id", "row_hash", "base", F.concat(*every).alias("uses"))


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS))


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def good_patterns(edges: DataFrame) -> DataFrame:
    """``pattern, kind, score`` of patterns that nearly only hold known instances of one kind."""
    sums = [F.sum(F.when(F.col("kind") == n, F.col("conf"))).alias(f"known_{n}") for n in range(len(KINDS))]
    counted = edges.groupBy("pattern").agg(F.count("*").alias("all"), *sums)
    each = F.array(*[F.struct(F.lit(n).alias("kind"), F.col(f"known_{n}").alias("known")) for n in range(len(KINDS))])
    scored = counted.select("pattern", "all", F.inline(each))
    score = F.col("known") / (F.col("all") + 1)
    return scored.select("pattern", "kind", score.alias("score")).where(F.col("score") >= PATTERN_SCORE)


def new_instances(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """``instance, kind, conf`` of unknown instances that good patterns together vouch for."""
    unknown = edges.where(F.col("kind").isNull()).select("pattern", "instance", _salt("instance").alias("salt"))
    vouched = unknown.join(_salted(patterns), ["pattern", "salt"])
    conf = 1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
    named = vouched.groupBy("instance", "kind").agg(conf.alias("conf")).where(F.col("conf") >= INSTANCE_SCORE)
    best = F.max(F.struct("conf", (-F.col("kind")).alias("kind")))
    return named.groupBy("instance").agg(best.alias("best")).select(
        "instance", (-F.col("best.kind")).alias("kind"), F.col("best.conf").alias("conf")
    )


def bootstrap(edges: DataFrame, staging: Staging, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Good patterns and the instances they discover, from ``edges(pattern, instance, kind, conf)``.

    A round scores patterns by the instances known so far, then instances by good patterns. It ends
    when nothing new is found, after ``rounds`` at the latest. Hot patterns and instances are
    aggregated in parts, and salted where they are joined.
    """
    patterns = discovered = None
    for k in range(rounds):
        patterns = staging.table(good_patterns(edges), f"patterns-{k}")
        new = staging.table(new_instances(edges, patterns), f"instances-{k}")
        discovered = new if discovered is None else discovered.unionByName(new)
        if new.isEmpty() or k + 1 == rounds:
            break
        told = _salted(new.withColumnsRenamed({"kind": "new_kind", "conf": "new_conf"}))
        edges = staging.table(
            edges.withColumn("salt", _salt("pattern")).join(told, ["instance", "salt"], "left").select(
                "pattern", "instance", F.coalesce("kind", "new_kind").alias("kind"),
                F.coalesce("conf", "new_conf").alias("conf"),
            ), f"edges-{k + 1}",
        )
        staging.drop(f"edges-{k}")
    return patterns, discovered


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id, base, found`` of every row of ``docs``: spans in code points, ends excluded.

    ``base`` has the matches of the patterns, ``found`` places of discovered instances in good
    patterns; both are arrays of ``start, kind, end`` with the kind's number in ``KINDS``, sorted. A null
    text counts as empty and has none. A null or repeated ``doc_id`` is a row like any other; repeated
    rows give repeated results, but a pattern and an instance count as one pair however often they
    occur, so copies of documents do not vouch for anything. An empty table gives an empty result;
    other columns are not looked at. Texts of any length are read whole; context words come
    from ``CONTEXT`` characters on either side.
    """
    staging = stage_for(docs.sparkSession)
    rows = staging.table(found_spans(docs, id_col, text_col), "spans")
    uses = rows.select("doc_id", "row_hash", F.inline("uses"))
    pairs = uses.select("instance", "kind", F.explode(F.array_distinct("patterns")).alias("pattern"))
    edges = pairs.groupBy("pattern", "instance").agg(F.min("kind").alias("kind"))
    edges = edges.withColumn("conf", F.when(F.col("kind").isNotNull(), F.lit(1.0)))
    patterns, discovered = bootstrap(staging.table(edges, "edges-0"), staging, rounds)

    places = uses.where(F.col("kind").isNull()).select(
        "doc_id", "row_hash", "start", "end", "instance", F.explode("patterns").alias("pattern")
    )
    places = places.withColumn("salt", _salt("row_hash"))
    places = places.join(_salted(discovered.select("instance", "kind")), ["instance", "salt"])
    places = places.join(_salted(patterns.select("pattern", "kind")), ["pattern", "kind", "salt"])
    found = places.groupBy("doc_id", "row_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("found")
    )
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.row_hash") == F.col("r.row_hash"))
    joined = rows.alias("l").join(found.alias("r"), same, "left")
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return joined.select("l.doc_id", "l.base", F.coalesce("r.found", empty).alias("found"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
