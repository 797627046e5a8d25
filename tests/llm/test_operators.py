"""Operators on small inputs against plain versions: nulls, empty and long texts, ties, repeats."""

import random
import textwrap
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docquay.llm import (
    chat,
    common,
    decontamination,
    exact_dedup,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    lm_scoring,
    mixing,
    quality,
)
from docquay.llm.common import fold
from docquay.llm.components import components
from docquay.sources.staging import Staging
from tests.llm import plain

# Names that operators use inside; they must not get in the way.
EXTRA = "doc_id long, text string, source string, digest string, keep_id string, slot int, node int, n int, token string, position int"


def table(spark, rows, schema=EXTRA):
    width = len(schema.split(","))
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)


@pytest.fixture(scope="module")
def prose():
    """Random texts with near and exact copies, edge cases and one text of 200,000 words."""
    draw = random.Random(5)
    words = [f"{a}{b}" for a in "Ba Ce Di Fo Gu Ha".split() for b in "la mé ni so tu ra ke".split()]

    def text(n):
        return " ".join(draw.choice(words) for _ in range(n))

    rows = [(k, text(draw.choice([3, 6, 30, 80]))) for k in range(60)]
    for k in range(60, 90):
        base = rows[draw.randrange(12)][1].split()
        if len(base) > 20:
            for _ in range(draw.randrange(3)):
                base[draw.randrange(len(base))] = "changed"
        rows.append((k, " ".join(base)))
    rows += [(90, rows[0][1].upper()), (91, rows[0][1] + "  "), (92, ""), (93, None), (94, " \n\t "),
             (95, "one"), (96, "ONE"), (97, "É one"), (98, "é one")]
    long = text(200_000)
    return rows + [(99, long), (100, long.lower())]


def test_exact_groups(spark, prose):
    rows = [*prose, (None, prose[0][1]), (None, "only here"), (5, prose[5][1])]
    got = exact_dedup.exact_groups(table(spark, rows), keep="largest")
    got = sorted(map(tuple, got.select(
        "doc_id", "keep_id", "group_size", F.lower(F.hex("digest"))).collect()), key=repr)
    assert got == sorted(plain.exact_groups(rows), key=repr)
    few = exact_dedup.exact_groups(table(spark, rows[:3] + rows[:3]), keep="smallest")
    assert {r.group_size for r in few.collect()} == {2}
    kept = exact_dedup.keep_one(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert kept.count() == len({plain.lower(t) for _, t in rows})


def test_exact_groups_of_one_hot_text(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("Same").alias("text"))
    assert exact_dedup.exact_groups(rows, keep="largest").where("keep_id = 3999 and group_size = 4000").count() == 4000


def test_components(spark, tmp_path):
    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    edges += [(500, k) for k in range(501, 560)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(df, Staging(spark, str(tmp_path)), "t").collect()))
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    low = plain.join_groups(nodes, [e for e in edges if e[0] != e[1]])
    assert got == low


def test_jaccard_components(spark, prose):
    got = jaccard_join.jaccard_components(table(spark, prose)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.jaccard_components(prose)


def test_jaccard_pieces():
    draw = np.random.default_rng(2)
    for n in (1, 3, 7, 50, 400):
        a = draw.integers(0, 1 << 63, n).astype(np.uint64)
        bits = jaccard_join.bitmap(a)
        assert len(jaccard_join.tiled(bits, 4 * len(bits))) == 4 * len(bits)
        assert jaccard_join.prefix_length(n) == n - -(-3 * n // 4) + 1
    assert jaccard_join.similar(4, 3, 3) and not jaccard_join.similar(400, 300, 299)
    assert jaccard_join.least_overlap(7) == 3
    sets = jaccard_join.shingle_sets(pa.array(["a b c d e f a b c d e", "", None, "x", "X", "a b"]))
    assert [len(s) for s in sets] == [6, 0, 0, 1, 1, 1]
    assert sets[3] == sets[4]


def test_columns_of_the_user_stay(spark):
    """Names that the operators use inside, nulls, empty and repeated rows; every column comes back."""
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, "a", "b", "c"), (2, text + " more", None, "b", None), (2, text + " more", "x", "y", "z"),
            (None, text, None, None, None), (3, None, "n", None, None), (4, "", "e", None, None), (3, None, "n", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __hash string, __digest string, __DIGEST_ string")
    near = jaccard_join.keep_first(docs)
    assert near.columns == docs.columns
    kept = {tuple(r) for r in near.collect()}
    assert kept <= set(rows) and sorted(str(r[0]) for r in kept) == ["1", "3", "4"]
    exact = exact_dedup.keep_one(docs)
    assert exact.columns == docs.columns
    kept = [tuple(r) for r in exact.collect()]
    assert set(kept) <= set(rows) and sorted(str(r[0]) for r in kept) == ["1", "2", "4"]


def test_jaccard_groups(spark, monkeypatch):
    """Groups of near copies, chains and shared passages, with one leader and very small pages."""
    monkeypatch.setattr(jaccard_join, "PAGE", 2)
    monkeypatch.setattr(jaccard_join, "LEADERS", 1)
    draw = random.Random(8)
    rows = []
    for group in range(3):
        base = [f"w{group}-{k}" for k in range(120)]
        for _ in range(30):
            own = list(base)
            for _ in range(draw.randrange(1, 5)):
                own[draw.randrange(120)] = f"x{draw.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    # A chain in which only neighbours are similar, and texts that share a passage and nothing else.
    chain = [f"c{k}" for k in range(400)]
    rows += [(1000 + k, " ".join(chain[8 * k : 8 * k + 100])) for k in range(30)]
    rows += [(2000 + k, " ".join([*chain[:60], *(f"y{k}-{j}" for j in range(40))])) for k in range(30)]
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.jaccard_components(rows)


def test_jaccard_leaders(spark, monkeypatch):
    """Near copies that are similar to the text they come from more than to each other or the first."""
    draw = random.Random(11)
    base = [f"w{k}" for k in range(120)]

    def edited(*places):
        return " ".join(f"x{draw.randrange(10**9)}" if k in places else w for k, w in enumerate(base))

    rows = [(0, edited(30, 60, 90))]
    rows += [(k, edited(*draw.sample(range(10, 50), 1), *draw.sample(range(60, 110), 1))) for k in range(1, 60)]
    rows += [(100, " ".join(base))]
    seen = []

    def counted(*args, whole=jaccard_join.tree_pairs):
        seen.append(whole(*args))
        return seen[-1]

    monkeypatch.setattr(jaccard_join, "tree_pairs", counted)
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.jaccard_components(rows)
    assert {r.component_id for r in got} == {0}
    # All are connected by leaders: not one of the 1,662 pairs that the first text as leader leaves.
    assert [f.count() for f in seen] == [0]


def test_jaccard_pairs_out_of_reach(spark, monkeypatch):
    """A group whose pairs are mostly just not similar: the trees leave few of its 1,770 pairs."""
    draw = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        own = list(base)
        for at in draw.sample(range(120), 3):
            own[at] = f"x{draw.randrange(10**9)}"
        rows.append((k, " ".join(own)))
    seen = []

    def counted(*args, whole=jaccard_join.tree_pairs):
        seen.append(whole(*args))
        return seen[-1]

    monkeypatch.setattr(jaccard_join, "tree_pairs", counted)
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.jaccard_components(rows)
    assert [f.count() < 300 for f in seen] == [True]


def test_jaccard_marks():
    """Pages tell a pair in one bucket, and the bound by first shingles is never under the overlap."""
    draw = np.random.default_rng(6)
    sets, firsts, facts = [], [], []
    for _ in range(40):
        s = np.unique(draw.choice(90, draw.integers(20, 80), replace=False).astype(np.uint64) << np.uint64(40))
        order = np.lexsort((s, s >> np.uint64(44)))  # several shingles of a weight
        first = s[order[: jaccard_join.prefix_length(len(s))]]
        place = jaccard_join.place_of(int(first[-1] >> np.uint64(44)), int(first[-1]))
        sets.append(s)
        firsts.append(first.astype(np.int64))
        bits = jaccard_join.bitmap(s)
        facts.append({"cls": len(facts), "comp": len(facts), "n": len(s), "reach": place, "bits": bits.tobytes(),
                      "spare": len(s) - int(np.bitwise_count(bits).sum()), "marks": firsts[-1].tolist(),
                      "times": [1] * len(first)})
    page = pa.array(facts)
    token = int(np.median(np.concatenate(firsts)))
    shared, before = jaccard_join.shared_marks(page, page, token)
    n, reach = (page.field(c).to_numpy() for c in ("n", "reach"))
    most = jaccard_join.most_overlap(n[:, None], n, reach[:, None], reach, shared, (75, 100))
    for a in range(40):
        for b in range(40):
            both = np.intersect1d(firsts[a], firsts[b])
            assert shared[a, b] == len(both) and before[a, b] == bool((both < token).any())
            assert a == b or most[a, b] >= len(np.intersect1d(sets[a], sets[b]))
    twice = pa.array(facts[:1] * 2).to_pylist()
    twice[1] |= {"cls": 99, "comp": 99}
    names = ["token", "xband", "xslot", "yband", "yslot", "xpage", "ypage"]
    rows = [dict(zip(names, (t, 0, 0, 0, 0, twice, twice))) for t in firsts[0].tolist()]
    task = jaccard_join._page_pairs((75, 100), ["bits", "marks", "times", "reach"])
    told = [r for row in rows for out in task([pa.RecordBatch.from_pylist([row])]) for r in out.to_pylist()]
    assert told == [{"a": 0, "b": 99}]


def test_jaccard_tree_levels(spark, tmp_path, monkeypatch):
    """A bucket of many unlike sets, with pages so small that the tree has three levels."""
    monkeypatch.setattr(jaccard_join, "PAGE", 2)
    draw = np.random.default_rng(4)
    sets = [draw.choice(5000, 60, replace=False).astype(np.uint64) * np.uint64(77777777777) for _ in range(900)]
    for k in range(0, 900, 9):
        sets[k + 1] = np.concatenate([sets[k][:55], draw.choice(5000, 5).astype(np.uint64)])
    sets = [np.unique(s) for s in sets]
    rows = []
    for k, s in enumerate(sets):
        bits = jaccard_join.bitmap(s)
        rows.append((1, k, k, len(s), len(s) - int(np.bitwise_count(bits).sum()), bytes(bits.tobytes())))
    members = spark.createDataFrame(rows, "token long, cls long, comp long, n long, spare long, bits binary")
    found = jaccard_join.tree_pairs(members, Staging(spark, str(tmp_path)), (75, 100), "t")
    found = {tuple(r) for r in found.collect()}
    linked = {
        (a, b) for a in range(900) for b in range(a + 1, 900)
        if jaccard_join.similar(len(sets[a]), len(sets[b]), len(np.intersect1d(sets[a], sets[b])))
    }
    assert len(linked) >= 90 and linked <= found


def test_contamination(spark, prose):
    words = [t.split() for _, t in prose if t and len(t.split()) == 80]
    items = [(1, " ".join(words[0][5:30])), (2, "three short words"), (3, None), (4, "..."), (None, "nowhere to be found"),
             (10, " ".join(words[1][:12]).upper()), (11, " ".join(words[0][20:34])), (12, "Bala " * 12)]
    docs = [*prose, (201, "see: three, SHORT-words."), (202, "Bala " * 40), (202, "three short"), (203, "")]
    docs = [d for d in docs if d[0] not in (99, 100)] + [(99, prose[-2][1][:40_000])]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(table(spark, docs), items_df)
    got = sorted(map(tuple, got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()))
    want = []
    for d in docs:
        want += [(d[0], *v) for v in plain.contamination([d], [i for i in items if i[0] is not None]).values()]
    assert got == sorted(want)
    clean = decontamination.keep_clean(table(spark, docs), items_df)
    assert clean.columns == table(spark, docs).columns
    assert clean.count() == sum(not w[-1] for w in want)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "aa zebra bb cc quagga dd"), (2, "aa zebra bb quagga dd"), (3, "quagga zebra")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "zebra bb quagga")], "item_id long, text string")
    got = decontamination.contamination(docs, items, slop=1).orderBy("doc_id").collect()
    assert [(r.n_hit, r.n_near) for r in got] == [(0, 1), (3, 1), (0, 0)]


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 50, "c": 10, None: 40}, {"a": 5}, {"a": 1000, "b": 1, "c": 1, "d": 1}, {"x": 0, "y": 10},
    {f"s{k}": 7 * k + 1 for k in range(20)},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = plain.targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-5 for s in want)


def test_mix(spark, prose):
    rows = [(k, t, [None, "a", "b"][(k or 0) % 3]) for k, t in [*prose, (None, "three more words"), (3, "again")]]
    docs = table(spark, rows)
    got = mixing.mix(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=repr)
    taken, target, sizes = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        target[r.source] = r.target
    assert len(got) == len(rows)
    assert all(taken[s] == int(target[s]) for s in taken)
    assert sizes == defaultdict(int, {s: sum(len(plain.space_words(t)) for _, t, x in rows if x == s) for s in sizes})


def test_quality_model(spark):
    draw = random.Random(1)

    def clean():
        return " ".join(draw.choice("the river and a house were green of old stone".split()) for _ in range(draw.randrange(3, 60))).capitalize() + "."

    def junk():
        w = clean().split()
        return draw.choice([" ".join(x.upper() + "!!" for x in w), " ".join(x + "$$$" for x in w), " ".join([w[0]] * 30)])

    rows = [(k, clean() if k % 4 else junk(), int(k % 4 > 0)) for k in range(800)]
    rows += [(900, None, 1), (901, "", 1), (902, "no label", None), (903, "other", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit_quality(df.where((F.col("doc_id") < 500) | (F.col("doc_id") >= 900)))
    got = {r.doc_id: r for r in quality.score_quality(df, model).collect()}
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [r for r in rows if 500 <= r[0] < 800]
    assert sum(got[k].predicted == q for k, _, q in held) >= 0.97 * len(held)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got.values())
    none = quality.fit_quality(df.where("quality is null"))
    assert {r.score for r in quality.score_quality(df, none).collect()} == {0.5}
    ones = quality.fit_quality(df.where("quality = 1"))
    assert {r.predicted for r in quality.score_quality(df, ones).collect()} == {1}


def test_quality_tasks_bound_their_memory(monkeypatch):
    """Batches are scored in pieces, and every task hands its memory back when it ends."""
    ends = []
    monkeypatch.setattr(common.gc, "collect", lambda: ends.append(1))
    whole = pa.RecordBatch.from_pydict({
        "block": pa.array([0, 0, 0], pa.int32()), "key": pa.array([1, 2, 3], pa.int64()),
        "label": pa.array([0, 1, 1], pa.int32()), "text": ["x" * (3 << 20), None, "one two " * (1 << 19)],
    })
    made = list(quality._featurize(quality.ORDERS, quality.BITS)([whole]))
    assert len(made) > 1 and sum(b.num_rows for b in made) == 3 and len(ends) == 1
    rows = pa.concat_batches(made)
    list(quality._counts(quality.BITS)([rows]))
    ratios = np.ones(1 << quality.BITS)
    list(quality._norms(ratios, quality.BITS)([rows]))
    lists = pa.RecordBatch.from_pydict({
        "block": pa.array([0], pa.int32()), "labels": pa.array([rows["label"].to_pylist()], pa.list_(pa.int32())),
        "features": pa.array([rows["features"].to_pylist()], pa.list_(pa.binary())),
    })
    step = quality._descend(ratios, np.zeros_like(ratios), 0.0, 1.0, {}, 1, quality.COST, 1)
    assert list(step([lists]))[0].column("block").to_pylist() == [0]
    assert len(ends) == 4


def test_languages(spark):
    draw = random.Random(2)
    lexicon = {
        "xa": "boru kelim sata nour velto gira".split(), "xb": "schig dwent pfolk strang znoch".split(),
        "ru": "дом река поле небо город".split(), "el": "θαλασσα ουρανος δρομος".split(),
    }
    rows = [(k, " ".join(draw.choice(lexicon[lang]) for _ in range(draw.randrange(2, 40))), lang)
            for k, lang in enumerate(draw.choice(list(lexicon)) for _ in range(400))]
    rows += [(500, None, "xa"), (501, "", "xa"), (502, "12 -- 7", "xb"), (503, "boru", None)]
    mixed = "boru kelim sata nour velto gira boru sata dwent pfolk strang znoch schig strang"
    rows += [(504, mixed, None), (505, "река поле " * 9 + "boru kelim sata nour", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_languages(df.where(fold("doc_id", 3) != 1))
    assert model.languages == ("el", "ru", "xa", "xb")
    got = {r.doc_id: r for r in language_id.identify_languages(df, model).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows[:400])
    assert [got[k].lang_pred for k in (500, 501, 502, 503, 504, 505)] == ["und"] * 3 + ["xa", "xa", "ru"]
    assert [(s.lang, s.first_word, s.words) for s in got[504].spans] == [("xa", 0, 8), ("xb", 8, 6)]
    assert [s.lang for s in got[505].spans] == ["ru", "xa"]
    nothing = language_id.fit_languages(df.where("lang is null"))
    assert {r.lang_pred for r in language_id.identify_languages(df, nothing).collect()} == {"und"}


def test_viterbi_is_best():
    draw = np.random.default_rng(6)
    scores = -draw.random((40, 3)) * 6
    codes = draw.integers(0, 40, 30)
    starts, ends = np.array([0, 9, 9, 10]), np.array([9, 9, 10, 30])
    labels = language_id.viterbi(scores, codes, starts, ends, switch=2.0)
    for a, b in zip(starts, ends):
        if a < b:
            path, rows = labels[a:b], scores[codes[a:b]]
            value = rows[np.arange(b - a), path].sum() - 2.0 * (path[1:] != path[:-1]).sum()
            if b - a < 10:
                assert abs(value - plain.viterbi(rows.tolist(), 2.0)) < 1e-9


def test_lm_scores(spark, prose):
    docs = table(spark, prose)
    got = lm_scoring.lm_scores(docs, fold("doc_id", 10) == 0, lookup_share=1e-4, cluster_share=1e-3).collect()
    want = plain.base_scores(prose)
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert r.score < 0
    # The lookup is only a faster way to the same counts.
    joined = lm_scoring.lm_scores(docs, fold("doc_id", 10) == 0, lookup_share=1.0, cluster_share=1.0).collect()
    assert all(abs(r.base_score - want[r.doc_id][4]) < 1e-6 * max(1, abs(want[r.doc_id][4])) for r in joined)
    nothing = lm_scoring.lm_scores(docs.limit(5), F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in nothing)


def test_exchange_gains():
    """A word that stands where the words of another class stand moves there."""
    left = np.array([[0.0, 0, 50, 0]])
    right = np.array([[0.0, 0, 0, 50]])
    class_left = np.array([[0.0, 0, 50, 0], [0.0, 0, 900, 0]])
    class_right = np.array([[0.0, 0, 0, 50], [0.0, 0, 0, 900]])
    class_left[0] += [400, 0, 0, 0]
    class_right[0] += [0, 400, 0, 0]
    assert lm_scoring.best_classes(left, right, np.array([0]), class_left, class_right)[0] == 1


def test_line_dedup(spark):
    draw = random.Random(9)
    vocabulary = [f"w{k}ord" for k in range(400)]
    lines = [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(4, 60))) for _ in range(120)]
    near = [x.replace(x.split()[0], x.split()[0] + "s", 1) for x in lines[:60]]
    pool = [*lines, *near, *(x.upper() + " !" for x in lines[:20]), "", "---"]
    rows = [(k, "\n".join(draw.choice(pool) for _ in range(draw.randrange(1, 9)))) for k in range(70)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "tall " * 70_000), (104, "Tall " * 70_000), (7, rows[7][1]), (7, "other text")]
    got = line_dedup.dedup_lines(table(spark, rows)).collect()
    assert len(got) == len(rows)
    # Plain: the same links by SimHash distance and edit distance, from the hashes of Spark.
    docs = table(spark, rows)
    hashed = line_dedup.line_hashes(docs).select("line", "simhash").distinct().collect()
    simhash = {r.line: r.simhash & (1 << 64) - 1 for r in hashed}
    norms = dict(line_dedup.text_lines(docs).select(F.xxhash64("words"), "words").distinct().collect())
    short = [k for k in norms if len(norms[k]) < 5000]
    links = []
    for i, a in enumerate(short):
        for b in short[:i]:
            if (simhash[a] ^ simhash[b]).bit_count() <= 3:
                most = max(len(norms[a]), len(norms[b]))
                if plain.edit_distance(norms[a], norms[b]) <= int((1.0 - line_dedup.SIMILARITY) * most):
                    links.append((a, b))
    assert links
    group = plain.join_groups(list(norms), links)
    seen, want = set(), defaultdict(list)
    hashes = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", line_dedup.row_hash(F.col("text")).alias("h")).collect()}
    named = {tuple(n): k for k, n in norms.items()}
    order = sorted(set(rows), key=lambda r: (r[0], hashes[r]))
    normal = {(r.doc_id, r.row_hash, r.position): tuple(r.words) for r in line_dedup.text_lines(docs).collect()}
    for r in order:
        for p, line in enumerate((r[1] if r[1] is not None else "").split("\n")):
            norm = normal.get((r[0], hashes[r], p))
            g = group[named[norm]] if norm else None
            if g is None or g not in seen:
                want[r].append(line)
                seen.add(g) if g is not None else None
    expected = sorted((r[0], "\n".join(want[r]) if r[1] is not None else None) for r in rows)
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id < 100) == [x for x in expected if x[0] < 100]
    long = {r.doc_id: r.n_removed for r in got}
    assert (long[100], long[102], long[103], long[104]) == (0, 0, 0, 1)


def test_simhash_bits(spark):
    """Packed counters against counting each bit."""
    rows = [(1, "a b c d e"), (2, "x " * 40_000 + "y z " * 9_000)]
    got = line_dedup.line_hashes(table(spark, rows)).collect()
    for r in got:
        words = dict(rows)[r.doc_id].split()
        hashes = {x.w: x.h & (1 << 64) - 1 for x in spark.createDataFrame([(w,) for w in set(words)], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
        want = sum(1 << b for b in range(64) if 2 * sum(hashes[w] >> b & 1 for w in words) > len(words))
        assert r.simhash & (1 << 64) - 1 == want


def test_simhash_of_pieces(spark):
    """Lines of all lengths around those that are counted in pieces, repeated rows among them."""
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(90)]
    sizes = [1, 2, 3, 62, 63, 64, 125, 126, 127, 300, 63 * 260, 63 * 260 + 1]
    rows = [(k, " ".join(draw.choices(vocabulary, k=n))) for k, n in enumerate(sizes)]
    got = line_dedup.line_hashes(table(spark, [*rows, rows[5], rows[5]])).collect()
    assert len(got) == len(rows) + 2
    hashes = {x.w: x.h & (1 << 64) - 1 for x in spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    for r in got:
        words = dict(rows)[r.doc_id].split()
        want = sum(1 << b for b in range(64) if 2 * sum(hashes[w] >> b & 1 for w in words) > len(words))
        assert (r.words, r.simhash & (1 << 64) - 1) == (len(words), want)


def test_near_hashes(spark):
    """Of all SimHashes only repeated ones and those with another one within reach stay; crowded keys give all."""
    draw = random.Random(8)
    far = [draw.getrandbits(64) for _ in range(300)]
    far += [far[0] ^ draw.getrandbits(20) << 40 | 1 for _ in range(40)]  # same low blocks, most of them not near
    near = [x ^ sum(1 << b for b in draw.sample(range(64), k % 5)) for k, x in enumerate(far[100:200])]
    all_of = [*far, *near, far[50]]
    want = {x for k, x in enumerate(all_of) if any((x ^ y).bit_count() <= 3 for j, y in enumerate(all_of) if j != k)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in all_of]
    rows = spark.createDataFrame(signed, "simhash long")

    def found(**limits):
        out = line_dedup.near_hashes(rows, line_dedup.stage_for(spark), **limits).collect()
        assert len(out) == len({r.simhash for r in out})
        return {r.simhash & (1 << 64) - 1 for r in out}

    assert 100 < len(want) < len(set(all_of)) - 100 and found() == want
    assert want <= found(group=5) <= set(all_of) and set(far[301:]) <= found(group=5)


def test_licenses(spark):
    grant, condition = licenses.SENTENCES["mit-grant"], licenses.SENTENCES["mit-condition"]
    rows = [
        (1, "Text.\nReleased under the MIT License.\nMore."), (2, f"{grant}:\n{condition}."),
        (3, f"{grant}: One. Two. Three. {condition}."), (4, f"{grant}: One. Two. {condition}."),
        (5, f"{condition}. {grant}."), (6, None), (7, ""), (8, "released UNDER the mit-license!"),
        (9, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0."),
        (9, "Nothing here."), (None, "Released under the MIT License."),
        (10, "Released under the MIT License. " * 5000), (11, "We released under the MIT License."),
        (2, f"{grant}:\n{condition}."),
    ]
    got = licenses.license_scan(table(spark, rows)).collect()
    got = sorted(((r.doc_id, r.licenses, r.n_matches) for r in got), key=repr)
    want = [(1, "MIT", 1), (2, "MIT", 1), (2, "MIT", 1), (3, "", 0), (4, "MIT", 1), (5, "", 0), (6, "", 0), (7, "", 0),
            (8, "MIT", 1), (9, "Apache-2.0,CC-BY-NC-4.0", 2), (9, "", 0), (None, "MIT", 1), (10, "MIT", 5000), (11, "", 0)]
    assert got == sorted(want, key=repr)


def test_near_window_with_a_term_that_no_text_has(spark):
    items = spark.createDataFrame([(1, "ab bc cd de ef fg gh hi ij unseen")], "item_id int, text string")
    rows = [(1, "x ab bc cd de ef fg gh hi ij other y"), (2, "ab only"), (3, "bc ab")]
    got = decontamination.contamination(table(spark, rows), items).collect()
    assert sorted((r.doc_id, r.n_hit, r.n_items, r.n_near) for r in got) == [(1, 0, 0, 1), (2, 0, 0, 0), (3, 0, 0, 0)]


def test_every_licence_rule_wrapped_and_unwrapped(spark):
    rows, want = [], []
    for k, (_, spdx, ids) in enumerate(licenses.RULES):
        whole = ". ".join(licenses.SENTENCES[s] for s in ids) + "."
        paragraphs = "\n\n".join(textwrap.fill(licenses.SENTENCES[s] + ".", 40) for s in ids)
        comment = "\r\n".join(f" * {x}" for x in textwrap.wrap(whole, 72))
        forms = [whole, textwrap.fill(whole, 70), textwrap.fill(whole, 25), paragraphs, comment,
                 f"Title line\n{textwrap.fill(whole, 60)}\nnext line"]
        for n, text in enumerate(forms):
            rows.append((10 * k + n, text))
            want.append((10 * k + n, spdx))
        rows.append((10 * k + 9, whole.rpartition(" ")[0]))
    got = {r.doc_id: r for r in licenses.license_scan(table(spark, rows)).collect()}
    assert [(k, got[k].licenses) for k, _ in want] == want
    gpl = 10 * [r[0] for r in licenses.RULES].index("gpl-2")
    assert (got[gpl].n_matches, got[gpl].n_sentences, got[gpl].first_position) == (1, 4, 0)
    assert got[gpl + 9].licenses == ""


def test_licence_steps_reach_on_and_short_raw_sentences(spark):
    known = {"a": "Alpha one", "b": "Beta two", "c": "Gamma", "m": "(MIT) License."}
    rules = (("r", "ABC", ("a", "b", "c")), ("m", "MIT", ("m",)))
    rows = [(1, "Alpha one. Beta two. x. Beta two. y. z. Gamma."), (2, "Alpha one. Beta two. x. x. x. Gamma."),
            (3, "MIT License"), (4, "MIT Licenses"), (5, "The MIT License")]
    got = licenses.license_matches(table(spark, rows), sentences=known, rules=rules).collect()
    assert sorted((r.doc_id, r.license, r.first_position, r.last_position) for r in got) == [(1, "ABC", 0, 6), (3, "MIT", 0, 0)]
    assert licenses.license_scan(table(spark, rows), sentences={}, rules=()).count() == 5


def test_preferences(spark):
    draw = random.Random(8)
    pairs, rows = {}, []
    for p in [*range(30), None]:
        base = [(draw.choice(["user", "assistant", None]), draw.choice(["hi", "no", "", None])) for _ in range(draw.randrange(0, 6))]
        sides = {s: base + [(draw.choice(["user", "assistant"]), draw.choice("ab")) for _ in range(draw.randrange(0, 4))] for s in ("chosen", "rejected")}
        pairs[p] = sides
        rows += [(p, s, k * 700, role, text) for s, turns in sides.items() for k, (role, text) in enumerate(turns)]
    rows += [(5, "neither", 0, "user", "x"), (5, None, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string").withColumn("place", F.lit("clash"))
    parts = chat.preference_turns(turns)
    got = defaultdict(list)
    for r in sorted(parts.collect(), key=lambda r: r.place):
        got[r.pair_id, r.part].append(r.rendered)
    whole = {r.pair_id: r for r in chat.preference_pairs(parts).collect()}
    for p, sides in pairs.items():
        want = plain.preference(sides["chosen"], sides["rejected"])
        for name, turns_ in zip(("prompt", "chosen", "rejected"), want):
            text = [f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns_]
            assert got[p, name] == text
            if p in whole:
                assert whole[p][name] == "".join(text)
        for name, turns_ in zip(("chosen", "rejected"), want[1:]):
            if p in whole:
                full = whole[p]["prompt"] + whole[p][name]
                masked = [full[a:b] for a, b in whole[p][f"{name}_mask"]]
                assert masked == [f"<|im_start|>assistant\n{t or ''}<|im_end|>\n" for r, t in turns_ if r == "assistant"]


def test_empty_tables(spark):
    docs = table(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    some = table(spark, [(1, "a text"), (2, None)])
    assert exact_dedup.exact_groups(docs).count() == 0
    assert jaccard_join.jaccard_components(docs).count() == 0
    assert decontamination.contamination(docs, items).count() == 0
    assert decontamination.contamination(some, items).where("contaminated").count() == 0
    assert mixing.mix(docs).count() == 0
    assert line_dedup.dedup_lines(docs).count() == 0
    assert licenses.license_scan(docs).count() == 0
    assert lm_scoring.lm_scores(docs, F.lit(False)).count() == 0
    model = language_id.fit_languages(docs.withColumn("lang", F.lit("x")))
    assert language_id.identify_languages(docs, model).count() == 0
    fitted = quality.fit_quality(docs.withColumn("quality", F.lit(1)))
    assert quality.score_quality(docs, fitted).count() == 0
    empty = spark.createDataFrame([], "pair_id long, side string, turn long, role string, text string")
    assert chat.preference_turns(empty).count() == 0
