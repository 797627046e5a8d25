"""Prefix trie against a plain one, with pieces and queues small enough to be cut and to spill."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from docquay.llm import prefix_trie as trie

# Names that the operator uses inside.
KINDS = "conv_id long, turn long, role string, text string, depth long, a long, leaves long, place long, length long"


def plain(conversations):
    """conv_id -> turns, to the rows of the result."""
    members = defaultdict(list)
    for conv_id, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv_id)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    totals = {}
    for key in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        leaves, saved = int(not children[key]), (len(members[key]) - 1) * words
        for c in children[key]:
            leaves, saved = leaves + totals[c][0], saved + totals[c][1]
        totals[key] = (leaves, saved)
    rows = []
    for key, ids in members.items():
        ends = ",".join(map(str, sorted(i for i in ids if len(conversations[i]) == len(key))))
        rows.append((min(ids), len(key), min(members[key[:-1]]) if key else None, len(ids), len(children[key]),
                     *totals[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows)


def result(spark, conversations, waiting=trie.WAITING, heavy=None):
    turns = [(c, d, *t) for c, own in conversations.items() for d, t in enumerate(own, 1)]
    table = spark.createDataFrame(
        [(c, None, role, text, d, 7, 7, 7, 7) for c, d, role, text in turns], KINDS)
    every = spark.createDataFrame([(c, "x", 9) for c in conversations], "conv_id long, depth string, length long")
    rows = trie.prefix_trie(every, table, waiting, heavy)
    assert rows.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, rows.collect()), key=lambda r: r[:2])


def drawn(seed, n, longest):
    draw = random.Random(seed)
    said = [("user", "Hi there"), ("assistant", ""), ("user", " a\tb "), ("", "é É"), ("user", "x" * 50)]
    out = {}
    for c in draw.sample(range(-50, 50_000), n):
        base = draw.choice(list(out.values())) if out and draw.random() < 0.7 else []
        own = [draw.choice(said) for _ in range(draw.randrange(longest))]
        out[c] = base[: draw.randrange(len(base) + 1)] + own
    return out


def test_trie(spark):
    conversations = drawn(1, 300, 6)
    conversations[-100] = []  # no turns
    conversations[60_000] = [("user", "word " * 100_000)]
    assert result(spark, conversations) == plain(conversations)


@pytest.mark.parametrize("levels, heavy, waiting", [(4, 3, 2), (2, 20, 1), (16, 1, 5), (3, 10_000, 1)])
def test_pieces_and_spilling(spark, monkeypatch, levels, heavy, waiting):
    """Paths over many blocks, nodes that many share, queues that hold next to nothing."""
    monkeypatch.setattr(trie, "LEVELS", levels)
    conversations = drawn(levels, 200, 5)
    trunk = [("user", str(k)) for k in range(40)]
    conversations.update({70_000 + k: trunk[: 5 + k] for k in range(35)})
    conversations.update({80_000 + k: [("user", "same")] * 3 for k in range(60)})
    assert result(spark, conversations, waiting, heavy) == plain(conversations)


def test_no_conversations(spark):
    assert result(spark, {}) == []
    assert result(spark, {4: []}) == plain({4: []})


def test_placed_turns(spark):
    rows = [(1, None, "user", "first"), (1, 5, None, "c"), (1, 5, "a", None), (1, 2, "z", "b"), (1, 2, "z", "b"),
            (None, 0, "user", "nobody's")]
    table = spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], KINDS)
    assert sorted(map(tuple, trie.placed_turns(table).collect())) == [
        (1, 0, "user", "first"), (1, 1, "z", "b"), (1, 2, "z", "b"), (1, 3, "", "c"), (1, 4, "a", "")]


def test_queue_keeps_order_over_many_files():
    draw = random.Random(4)
    queue, want = trie.WaitingTotals(limit=50), defaultdict(lambda: (0, 0, 0))
    for _ in range(20_000):
        key = (draw.randrange(20), draw.randrange(60), draw.randrange(-3, 3))
        totals = (1, draw.randrange(9), draw.randrange(1 << 40))
        queue.put(key, totals)
        want[key] = tuple(x + y for x, y in zip(want[key], totals))
    assert len(queue.files) > 5
    for key in sorted(want):
        assert queue.take(key) == want[key]
    assert not queue.heap and not queue.heads
