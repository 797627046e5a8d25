"""Licence scan: sentence rules.

Texts are cut into sentences, consecutive sentences whose normalised words are together those
of a known licence sentence are mapped to its identifier, and the identifiers of a text, in
order, are matched against ordered rules: a rule holds where its sentences follow one another
among the recognised ones, with at most ``gap`` other sentences in between.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquay.llm.common import ascii_lower, row_hash, stage_for
from docquay.sources.staging import Staging

# Licence sentences as their licences or customary notices word them.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software"
    ),
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-comply": (
        "you may not use this file except in compliance with the License"
    ),
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version"
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE"
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer"
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution"
    ),
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-notice": "Licensed under CC BY 4.0",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0",
}
# SPDX identifiers, each with the ordered sentences that show it.
RULES = (
    ("mit-1", "MIT", ("mit-notice",)),
    ("mit-2", "MIT", ("mit-licensed",)),
    ("mit-3", "MIT", ("mit-grant", "mit-condition")),
    ("mit-4", "MIT", ("mit-title", "mit-grant")),
    ("apache-1", "Apache-2.0", ("apache-notice",)),
    ("apache-2", "Apache-2.0", ("apache-comply", "apache-copy")),
    ("gpl-1", "GPL-3.0-only", ("gpl3-notice",)),
    ("gpl-2", "GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("bsd-2", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("cc-1", "CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("cc-2", "CC-BY-4.0", ("cc-by-notice",)),
    ("cc-3", "CC-BY-SA-4.0", ("cc-by-sa-notice",)),
)
#: A sentence ends at a line end, or at . ! ? : ; that white space follows.
SENTENCE_END = r"[\r\n]+|(?<=[.!?:;])[ \t]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: So many sentences may stand between two of a rule.
GAP = 2


def normal_sentence(sentence: Column) -> Column:
    """Letters and digits, A-Z lowered, with one space in place of everything else."""
    return F.trim(F.regexp_replace(ascii_lower(sentence), NOT_WORD, " "))


def _start(norm: Column) -> Column:
    """First two words of a normalised text, or the first alone where there is no other."""
    return F.substring_index(norm, " ", 2)


def _marks(norms: list[str]) -> list[str]:
    """The longest word of each sentence: a text without any of them has no known sentence."""
    return sorted({max(norm.split(), key=lambda word: (len(word), word)) for norm in norms})


def sentence_table(spark: SparkSession, sentences: dict[str, str] = SENTENCES) -> DataFrame:
    rows = spark.createDataFrame(list(sentences.items()), "sentence_id string, raw string")
    return rows.select("sentence_id", normal_sentence(F.col("raw")).alias("norm"))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [
        (rule, spdx, len(ids), k, sentence)
        for rule, spdx, ids in rules for k, sentence in enumerate(ids)
    ]
    return spark.createDataFrame(
        rows, "rule string, license string, steps int, step int, sentence_id string"
    )


def _text_pass(
    docs: DataFrame, id_col: str, text_col: str, sentences: dict[str, str], staging: Staging
) -> DataFrame:
    """``doc_id, row_hash, n_sentences, runs`` of every row, written: all that is taken from texts.

    ``runs`` has one array for each place where a known sentence may begin: the sentences from
    there on that have a word, normalised, each with its position in the text, as many as the
    longest known sentence has words. It is null for texts without any such place. Each text is
    lowered and cut once, and each sentence of a text that has a mark is normalised once.
    """
    norms = [r.norm for r in sentence_table(docs.sparkSession, sentences).select("norm").collect()]
    norms = [norm for norm in norms if norm]
    most = max((len(norm.split()) for norm in norms), default=0)
    starts = sorted({" ".join(norm.split()[:2]) for norm in norms})
    single = any(" " not in norm for norm in norms)

    # Exploded as the only element, a value is made once, not once for each use below.
    once = lambda value, name: F.explode(F.array(value)).alias(name)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_hash(F.col(text_col)).alias("row_hash"),
        once(ascii_lower(F.col(text_col)), "__text"),
    )
    marked = reduce(
        lambda x, y: x | y, [F.col("__text").contains(mark) for mark in _marks(norms)], F.lit(False)
    )
    rows = rows.select(
        "doc_id", "row_hash", marked.alias("__marked"), F.coalesce(F.col("__text") == "", F.lit(True)).alias("__none"),
        once(F.split("__text", SENTENCE_END), "__raw"),
    )
    pieces = F.transform("__raw", lambda x, i: F.struct(
        i.alias("position"), F.trim(F.regexp_replace(x, NOT_WORD, " ")).alias("norm")
    ))
    rows = rows.select(
        "doc_id", "row_hash",
        F.when(F.col("__none"), F.lit(0)).otherwise(F.size("__raw")).cast("long").alias("n_sentences"),
        once(F.when(F.col("__marked"), F.filter(pieces, lambda x: x["norm"] != "")), "__full"),
    )

    def run(piece: Column, i: Column) -> Column:
        begin = _start(F.concat_ws(" ", piece["norm"], F.get("__full", i + 1)["norm"]))
        here = begin.isin(starts)
        if single:
            here = here | F.substring_index(begin, " ", 1).isin(starts)
        return F.when(here, F.slice("__full", i + 1, most))

    runs = F.filter(F.transform("__full", run), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "row_hash", "n_sentences", once(runs, "runs"))
    some = F.when(F.size("runs") > 0, F.col("runs"))
    return staging.table(rows.withColumn("runs", some), "texts")


def _known_runs(rows: DataFrame, sentences: dict[str, str]) -> DataFrame:
    """``doc_id, row_hash, position, last, sentence_id`` out of ``_text_pass``."""
    known = sentence_table(rows.sparkSession, sentences).where("norm <> ''")
    known = known.withColumn("start", _start(F.col("norm")))
    runs = rows.where("runs is not null").select("doc_id", "row_hash", F.explode("runs").alias("run"))
    begin = F.array_join(F.slice("run.norm", 1, 2), " ")
    keys = F.array_distinct(F.array(_start(begin), F.substring_index(begin, " ", 1)))
    runs = runs.select("doc_id", "row_hash", "run", F.explode(keys).alias("start"))
    # A known sentence is there if the run begins with its words and one of the run's sentences
    # ends where they end.
    joined = runs.join(F.broadcast(known), "start").where(
        F.concat(F.array_join("run.norm", " "), F.lit(" ")).startswith(F.concat("norm", F.lit(" ")))
    )
    nothing = F.struct(F.lit(0).alias("length"), F.lit(None).cast("int").alias("last"))

    def ahead(so_far: Column, piece: Column) -> Column:
        length = so_far["length"] + F.char_length(piece["norm"]) + 1
        ends = length == F.char_length("norm") + 1
        return F.struct(
            length.alias("length"), F.when(ends, piece["position"]).otherwise(so_far["last"]).alias("last")
        )

    return joined.select(
        "doc_id", "row_hash", F.col("run")[0]["position"].alias("position"),
        F.aggregate("run", nothing, ahead)["last"].alias("last"), "sentence_id",
    ).where("last is not null")


def license_sentences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    sentences: dict[str, str] = SENTENCES,
) -> DataFrame:
    """``doc_id, row_hash, position, last, sentence_id``: every known sentence of every text.

    Positions count the sentences of the whole text. A known sentence may stand on several
    consecutive ones, from ``position`` to ``last``: line ends and marks inside it do not
    matter, as when its text is wrapped. The longest words of the known sentences narrow the
    texts down, and their first two words the places. The rule tables are fixed values of this
    module or of the caller, so their broadcast is bounded.
    """
    staging = stage_for(docs.sparkSession)
    return _known_runs(_text_pass(docs, id_col, text_col, sentences, staging), sentences)


def license_matches(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    sentences: dict[str, str] = SENTENCES, rules=RULES, gap: int = GAP,
) -> DataFrame:
    """``doc_id, row_hash, rule, license, first_position, last_position`` of every match.

    A match of ``k`` steps is grown step by step: the next sentence of the rule must be
    among those recognised within ``gap`` + 1 sentences behind the last one of the step before.
    Each step is an equi-join on document and position, so a text that repeats a sentence costs
    as much as it is long. All places a step reaches are carried on; a match is reported once
    for each place where it begins, with the first place where it ends.
    Equal rows (same identifier and text) give the matches of one.
    """
    staging = stage_for(docs.sparkSession)
    texts = _text_pass(docs, id_col, text_col, sentences, staging)
    return _rule_matches(texts, sentences, rules, gap, staging)


def _rule_matches(
    texts: DataFrame, sentences: dict[str, str], rules, gap: int, staging: Staging
) -> DataFrame:
    found = staging.table(_known_runs(texts, sentences).distinct(), "found")
    steps = F.broadcast(rule_table(texts.sparkSession, rules))
    tagged = found.join(steps, "sentence_id")
    live = tagged.where("step = 0").select(
        "doc_id", "row_hash", "rule", "license", "steps",
        F.col("position").alias("first_position"), F.col("last").alias("last_position"),
    )
    done = live.where("steps = 1")
    key = ["doc_id", "row_hash", "rule"]
    for k in range(1, max((len(ids) for _, _, ids in rules), default=1)):
        reach = F.explode(F.sequence(F.lit(1), F.lit(gap + 1)))
        ahead = live.where(F.col("steps") > k).withColumn("__d", reach)
        ahead = ahead.withColumn("position", F.col("last_position") + F.col("__d"))
        step = tagged.where(F.col("step") == k).select(*key, "position", "last")
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*key, "position"]]
        live = (
            ahead.alias("l").join(step.alias("r"), same)
            .select(
                *[f"l.{c}" for c in [*key, "license", "steps", "first_position"]],
                F.col("r.last").alias("last_position"),
            ).distinct()
        )
        done = done.unionByName(live.where(F.col("steps") == k + 1))
    return done.groupBy(*key, "license", "first_position").agg(
        F.min("last_position").alias("last_position")
    )


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    sentences: dict[str, str] = SENTENCES, rules=RULES, gap: int = GAP,
) -> DataFrame:
    """``doc_id, n_sentences, n_matches, licenses, first_position`` of every row.

    ``licenses`` are the distinct licences found, sorted and joined by commas, empty if
    none; ``first_position`` is null then. Null and empty texts have no sentence. Rows
    with a null identifier, and repeated rows, each get their own result. An empty table
    gives an empty result, and other columns are not looked at.
    """
    staging = stage_for(docs.sparkSession)
    rows = _text_pass(docs, id_col, text_col, sentences, staging)
    matches = _rule_matches(rows, sentences, rules, gap, staging)
    totals = matches.groupBy("doc_id", "row_hash").agg(
        F.count("*").alias("n_matches"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.min("first_position").cast("long").alias("first_position"),
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("doc_id", "row_hash")]
    return rows.alias("l").join(totals.alias("r"), same, "left").select(
        "l.doc_id", "l.n_sentences",
        F.coalesce("r.n_matches", F.lit(0)).cast("long").alias("n_matches"),
        F.coalesce("r.licenses", F.lit("")).alias("licenses"), "r.first_position",
    )
