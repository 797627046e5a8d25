"""Queries of the operators over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquay.llm import (
    chat,
    conversation_repair,
    decontamination,
    exact_dedup,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    lm_scoring,
    mixing,
    personal_data,
    prefix_trie,
    quality,
)
from docquay.llm.common import fold, read_table, stage_for
from docquay.llm.quality import labelled_documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")
    return groups.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP1_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs.where(fold("doc_id", 3) != 1))
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return language_id.identify_languages(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit_quality(labelled_documents(docs, read_table(spark, sf_dir, "labels")))
    scored = quality.score_quality(docs, model)
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm_scoring.lm_scores(docs, fold("doc_id", 10) == 0)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


OP7_SQL = r"""
WITH doc AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
item AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(words, s, s + 9) AS win
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS s
        FROM item WHERE len(words) > 0)),
place AS (
  SELECT doc_id, words, unnest(generate_series(1, len(words))) AS s FROM doc WHERE len(words) > 0),
hit AS (
  SELECT p.doc_id, p.s, w.item_id, len(w.win) AS n
  FROM place p JOIN win w ON p.words[p.s] = w.win[1] AND list_slice(p.words, p.s, p.s + len(w.win) - 1) = w.win),
word AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS i FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


OP8_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, list_slice(words, s, s + 4) AS sh
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS s
        FROM doc WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.to_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id)
LEFT JOIN size USING (doc_id)
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER w, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0)) AS level,
         row_number() OVER (ORDER BY cap / weight, source IS NULL, source) AS turn
  FROM f WINDOW w AS (ORDER BY cap / weight, source IS NULL, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, round(CASE WHEN level0 IS NULL THEN cap
         ELSE least(cap, level0 * weight) END, 6) AS target
  FROM (SELECT *, arg_min(level, turn) FILTER (level * weight < cap) OVER () AS level0 FROM l)),
p AS (
  SELECT d.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
         CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END AS e
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (e * size + least(size, greatest(floor(target) - e * source_size - ahead, 0)))::BIGINT AS taken
FROM p
"""



def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation 2k is the chosen, 2k + 1 the rejected side of pair k."""
    turns = read_table(spark, sf_dir, "conversations")
    side = F.when(F.col("conv_id") % 2 == 0, F.lit("chosen")).otherwise(F.lit("rejected"))
    pairs = turns.withColumn("pair_id", F.floor(F.col("conv_id") / 2)).withColumn("side", side)
    return chat.preference_turns(pairs)


OP10_SQL = r"""
WITH t AS (
  SELECT conv_id // 2 AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side,
         role, text, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
  FROM conversations),
agree AS (
  SELECT c.pair_id, c.place FROM t c JOIN t r ON c.pair_id = r.pair_id AND c.place = r.place
  WHERE c.side = 'chosen' AND r.side = 'rejected'
    AND c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text),
gap AS (
  SELECT pair_id, min(place) AS shared FROM (SELECT DISTINCT pair_id, place FROM t) x
  WHERE NOT EXISTS (SELECT 1 FROM agree a WHERE a.pair_id = x.pair_id AND a.place = x.place) GROUP BY pair_id),
full_t AS (
  SELECT t.*, place < coalesce(shared, 1000000000) AS in_prompt,
         coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, side ORDER BY place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM t LEFT JOIN gap USING (pair_id))
SELECT pair_id, CASE WHEN in_prompt THEN 'prompt' ELSE side END AS part, place, role, rendered,
       NOT in_prompt AND role IS NOT DISTINCT FROM 'assistant' AS trained,
       start, start + length(rendered) AS "end"
FROM full_t WHERE NOT in_prompt OR side = 'chosen'
"""


#: CRC-32 of an ASCII text ``s``, as DuckDB has none.
CRC32_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS cells)"""
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({s}, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: xor(c >> 8, cells[(xor(c, b) & 255) + 1])), 4294967295)"""


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults that a hash of conversation and turn chooses: one of 20 rows each."""
    space = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    key = F.concat_ws(":", *named)
    fault = F.crc32(F.encode(key, "utf-8")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.withColumn("fault", fault).where(F.col("fault") != 0).select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.explode(F.array_repeat("fault", F.when(F.col("fault") == 3, 2).otherwise(1))).alias("fault"),
    )
    return rows.drop("fault")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    repaired = conversation_repair.repair_conversations(damaged(turns))
    every = turns.select("conv_id").distinct().alias("l")
    same = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id"))
    return every.join(repaired.alias("r"), same, "left").select(
        "l.conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in conversation_repair.COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


OP11_SQL = rf"""
WITH RECURSIVE crc AS {CRC32_TABLE},
code AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32.format(s="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM code WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut
  FROM damaged),
row_ AS (
  SELECT *, left(role, 1) AS r, cut = '' AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         right(cut, 1) NOT IN ('.', '!', '?') AS short,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (short AND NOT blank AND NOT again) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n
  FROM row_ GROUP BY conv_id),
way(a, ins, b, added) AS (VALUES
  ('n', '', 'n', ''), ('n', 'I', 'u', 'u'), ('n', 'II', 'a', 'ua'),
  ('s', '', 's', ''), ('s', 'I', 'u', 'u'), ('s', 'II', 'a', 'ua'),
  ('u', '', 'u', ''), ('u', 'I', 'a', 'a'), ('a', '', 'a', ''), ('a', 'I', 'u', 'u')),
step(conv_id, i, q, cost, audit, out_text) AS (
  SELECT conv_id, 0::BIGINT, 'n', 0::BIGINT, '', []::VARCHAR[] FROM counted
  UNION ALL
  SELECT conv_id, i, q, min(cost), arg_min(audit, (cost, audit)), arg_min(out_text, (cost, audit))
  FROM (
    SELECT s.conv_id, x.i, m.b AS q, s.audit || w.ins || m.letter AS audit,
           s.cost + 3 * len(w.ins) + m.price + CASE WHEN x.short AND m.letter <> 'D' THEN 3 ELSE 0 END AS cost,
           s.out_text || list_transform(list_filter(string_split(w.added, ''), lambda c: c <> ''),
                lambda c: CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
             || CASE m.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [x.role || ':' || x.text]
                ELSE [CASE m.b WHEN 'u' THEN 'user:' ELSE 'assistant:' END || x.text] END AS out_text
    FROM step s JOIN row_ x ON s.conv_id IS NOT DISTINCT FROM x.conv_id AND x.i = s.i + 1
    JOIN way w ON w.a = s.q
    JOIN (VALUES ('n', 'D', 'n', 4), ('s', 'D', 's', 4), ('u', 'D', 'u', 4), ('a', 'D', 'a', 4),
                 ('n', 'R', 'u', 3), ('s', 'R', 'u', 3), ('a', 'R', 'u', 3), ('u', 'R', 'a', 3),
                 ('n', 'K', 's', 0), ('n', 'K', 'u', 0), ('s', 'K', 'u', 0), ('a', 'K', 'u', 0), ('u', 'K', 'a', 0)
         ) m(a, letter, b, price) ON m.a = w.b
    WHERE m.letter = 'D' OR NOT x.blank AND NOT x.again AND (m.letter = 'R' OR m.b = x.r)
  ) GROUP BY conv_id, i, q),
ended AS (
  SELECT conv_id, min(cost + 3 * len(ins)) AS cost, min((cost + 3 * len(ins), audit || ins)) AS best,
         arg_min(out_text || list_transform(list_filter(string_split(added, ''), lambda c: c <> ''),
                lambda c: CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END),
                (cost + 3 * len(ins), audit || ins)) AS out_text
  FROM step JOIN way ON a = q JOIN counted USING (conv_id) WHERE i = n AND b IN ('n', 'a') GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(best[2], '') AS audit, sha256(coalesce(array_to_string(out_text, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted USING (conv_id) LEFT JOIN ended USING (conv_id)
"""


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal_data.personal_data(read_table(spark, sf_dir, "documents"))

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(n).alias(f"n_{kind}") for n, kind in enumerate(personal_data.KINDS)]
    every = F.array_sort(F.concat("base", "found"))
    return rows.select(
        "doc_id", *counts, F.sha2(personal_data.span_text(F.col("base")), 256).alias("base_sha256"),
        personal_data.span_text(every).alias("spans"),
    )


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with up to three turns of the one their block of 20 begins with.

    Returns every conversation, and their turns with depths from 1. A conversation is joined by
    blocks of turns, so that a long one is spread.
    """
    block = F.floor(F.col("place") / prefix_trie.LEVELS)
    placed = stage_for(turns.sparkSession).table(prefix_trie.placed_turns(turns), "placed")
    taken = F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % 4
    every = placed.groupBy("conv_id").agg((F.max("place") + 1).alias("length"))
    every = every.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 20, "taken": taken})
    bases = every.where("conv_id = base").select("base", F.col("length").alias("has"))
    every = every.join(bases, "base", "left")
    every = every.withColumn("n_head", F.least("taken", F.coalesce("has", F.lit(0))))
    heads = placed.where("conv_id % 20 = 0 AND place < 3").withColumnRenamed("conv_id", "base")
    heads = every.select("conv_id", "base", "n_head").join(heads, "base").where("place < n_head")
    spread = every.select("conv_id", "taken", "n_head", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / prefix_trie.LEVELS))).alias("block"))
    own = placed.withColumn("block", block).join(spread, ["conv_id", "block"]).where("place >= taken")
    own = own.withColumn("place", F.col("place") - F.col("taken") + F.col("n_head"))
    columns = ["conv_id", (F.col("place") + 1).alias("depth"), "role", "text"]
    return every.select("conv_id"), heads.select(*columns).unionByName(own.select(*columns))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, turns = rebuilt_conversations(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(every, turns)


OP13_SQL = rf"""
WITH crc AS {CRC32_TABLE},
placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC32.format(s="conv_id::VARCHAR")} % 4 AS taken
  FROM (SELECT DISTINCT conv_id FROM placed), crc),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM conv c JOIN placed p ON p.conv_id = c.base AND place < taken
  UNION ALL
  SELECT c.conv_id, 1, place, role, text FROM conv c JOIN placed p ON p.conv_id = c.conv_id AND place >= taken),
path AS (
  SELECT conv_id, count(*) OVER w AS depth, list((role, text)) OVER w AS turns, text FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, [], '' FROM conv),
member AS (
  SELECT conv_id, depth, text, min(conv_id) OVER n AS rep, count(*) OVER n AS n_convs,
         max(depth) OVER (PARTITION BY conv_id) = depth AS ends
  FROM path WINDOW n AS (PARTITION BY depth, turns)),
node AS (
  SELECT rep AS conv_id, depth, n_convs,
         (n_convs - 1) * len(regexp_extract_all(any_value(text), '[^ 	-
]+')) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY rep, depth, n_convs),
link AS (
  SELECT n.conv_id, n.depth, m.rep AS up, m.depth AS up_depth, n.saved
  FROM node n JOIN member m ON m.conv_id = n.conv_id AND m.depth <= n.depth),
child AS (SELECT up, up_depth, count(*) AS n FROM link WHERE up_depth = depth - 1 GROUP BY ALL),
below AS (
  SELECT l.up, l.up_depth, sum(l.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM link l LEFT JOIN child c ON c.up = l.conv_id AND c.up_depth = l.depth GROUP BY ALL)
SELECT n.conv_id, n.depth, p.up AS parent_conv_id, n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
       b.saved::BIGINT AS saved_tokens, ends_sha256
FROM node n JOIN below b ON b.up = n.conv_id AND b.up_depth = n.depth
LEFT JOIN child c ON c.up = n.conv_id AND c.up_depth = n.depth
LEFT JOIN link p ON p.conv_id = n.conv_id AND p.depth = n.depth AND p.up_depth = n.depth - 1
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_line_dedup": (op2_line_dedup, None),
    "op3_language_id": (op3_language_id, None),
    "op4_quality": (op4_quality, None),
    "op5_license_scan": (op5_license_scan, None),
    "op6_lm_scoring": (op6_lm_scoring, None),
    "op7_decontamination": (op7_decontamination, OP7_SQL),
    "op8_jaccard_join": (op8_jaccard_join, OP8_SQL),
    "op9_mixing": (op9_mixing, OP9_SQL),
    "op10_chat_formatting": (op10_chat_formatting, OP10_SQL),
    "op11_conversation_repair": (op11_conversation_repair, OP11_SQL),
    "op12_personal_data": (op12_personal_data, None),
    "op13_prefix_trie": (op13_prefix_trie, OP13_SQL),
    "pipeline": (pipeline, None),
}
