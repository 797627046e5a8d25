"""Registered queries over whole tables: against SQL, or against plain versions."""

import random
import textwrap

import duckdb
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from docquay.llm import licenses
from docquay.llm.common import fold
from docquay.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm import plain
from tests.test_queries import normal


def rows_of(name, *columns):
    data = pq.read_table(f"{SF_DIR}/{name}.parquet").to_pydict()
    return list(zip(*(data[c] for c in columns)))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(spark, duck, name):
    query, sql = QUERIES[name]
    df = query(spark, SF_DIR)
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cursor.fetchall(), columns)


def test_language_held_out(spark):
    langs = dict(rows_of("documents", "doc_id", "lang"))
    got = [r for r in QUERIES["op3_language_id"][0](spark, SF_DIR).collect()]
    assert len(got) == len(langs) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_held_out(spark):
    labels = dict(rows_of("labels", "doc_id", "quality"))
    got = [r for r in QUERIES["op4_quality"][0](spark, SF_DIR).collect()]
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert held and sum(r.predicted == labels[r.doc_id] for r in held) >= 0.85 * len(held)


def test_lm_scores(spark):
    want = plain.base_scores(rows_of("documents", "doc_id", "text"))
    got = QUERIES["op6_lm_scoring"][0](spark, SF_DIR).collect()
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_licenses(spark):
    marks = {"MIT": "Released under the MIT License", "Apache-2.0": "Apache License, Version 2.0",
             "GPL-3.0-only": "GNU General Public License, version 3", "CC-BY-NC-4.0": "CC BY-NC 4.0"}
    texts = dict(rows_of("documents", "doc_id", "text"))
    for r in QUERIES["op5_license_scan"][0](spark, SF_DIR).collect():
        assert r.licenses == ",".join(sorted(k for k, m in marks.items() if m in texts[r.doc_id]))
        want = plain.license_scan(texts[r.doc_id], licenses.SENTENCES, licenses.RULES, licenses.GAP)
        assert (r.n_sentences, r.n_matches, r.licenses, r.first_position) == want


def test_licenses_in_mixed_pieces(spark):
    """Known sentences whole, cut, wrapped and interrupted, against all runs of sentences."""
    draw = random.Random(5)
    known = list(licenses.SENTENCES.values())
    rows = []
    for k in range(150):
        parts = []
        for _ in range(draw.randrange(1, 9)):
            sentence = draw.choice(known)
            words = sentence.split()
            a = draw.randrange(len(words))
            parts.append(draw.choice([
                sentence, sentence.upper(), textwrap.fill(sentence, 20), "\n--\n".join(words),
                " ".join(words[:a]), " ".join(words[a:]), "Żółw", "Other words", "...",
                f"{' '.join(words[:a])} extra {' '.join(words[a:])}",
            ]))
        rows.append((k, draw.choice([". ", "\n", ": ", ".\r\n", "; * "]).join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_sentences, r.n_matches, r.licenses, r.first_position) for r in licenses.license_scan(docs).collect()}
    want = {k: plain.license_scan(text, licenses.SENTENCES, licenses.RULES, licenses.GAP) for k, text in rows}
    assert got == want and sum(x[1] > 0 for x in want.values()) > 30


def test_line_dedup(spark):
    texts = dict(rows_of("documents", "doc_id", "text"))
    seen = set()
    for r in sorted(QUERIES["op2_line_dedup"][0](spark, SF_DIR).collect()):
        lines = texts[r.doc_id].split("\n")
        kept = r.text.split("\n") if r.n_removed < r.n_lines else []
        assert r.n_lines == len(lines) and len(kept) == r.n_lines - r.n_removed
        assert not seen & {x for x in kept if any(c.isalnum() for c in x)}
        seen |= {x for x in kept if any(c.isalnum() for c in x)}
    assert {x for t in texts.values() for x in t.split("\n")} >= seen


def test_pipeline(spark):
    """Every stage works on what the one before kept, and takes out what it must."""
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    labels = dict(rows_of("labels", "doc_id", "quality"))
    items = rows_of("benchmark", "item_id", "text")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stage(spark, docs, SF_DIR)
        if k < 4:
            assert after.columns == columns
            after = after.cache()
            kept = {r.doc_id for r in after.collect()}
        if k == 0:
            # The fold that is not learned from, and what is not labelled.
            held = {r.doc_id for r in docs.where(fold("doc_id", 3) == 1).collect()} & set(labels)
            assert sum((i in kept) == labels[i] for i in held) >= 0.85 * len(held)
        elif k == 1:
            assert kept == {r[1] for r in plain.exact_groups(list(before.items()))}
        elif k == 2:
            assert kept == {low for _, low in plain.jaccard_components(list(before.items())).values()}
        elif k == 3:
            hit = plain.contamination(list(before.items()), items)
            assert kept == {i for i in before if not hit[i][-1]}
        else:
            rows = after.collect()
            assert {r.doc_id for r in rows} == set(before)
            assert sum(r.taken for r in rows) == sum(
                int(t) for t in {r.source: r.target for r in rows}.values())
        docs = after
