"""Conversation repair against a plain search over whole edit strings."""

import hashlib
import itertools
import random

import pytest

from docquay.llm import conversation_repair as repair

KINDS = "conv_id long, turn long, role string, text string, pos long, copies long, edit string, counts string"
WHITE = " \t\n\x0b\f\r"


def paths(rows, inserts=2):
    """Every legal edit string with its cost and what is left, by trying all of them."""
    found = []

    def go(k, state, cost, audit, left):
        if k == len(rows) and state in "na":
            found.append((cost, audit, tuple(left)))
        new = "u" if state in "nsa" else "a"
        name = {"u": "user", "a": "assistant"}[new]
        if len(audit) - len(audit.rstrip("I")) < inserts:
            go(k, new, cost + 3, audit + "I", [*left, f"{name}:"])
        if k == len(rows):
            return
        role, text, must_go, cut = rows[k]
        go(k + 1, state, cost + 4, audit + "D", left)
        if must_go:
            return
        more = 3 * cut
        go(k + 1, new, cost + more + 3, audit + "R", [*left, f"{name}:{text}"])
        if role[:1] == new or role[:1] == "s" and state == "n":
            go(k + 1, role[:1], cost + more, audit + "K", [*left, f"{role}:{text}"])

    go(0, "n", 0, "", [])
    return min(found)


def cheapest(rows):
    """The same by states, each with its least (cost, edits), which whole strings decide."""
    best = {"n": (0, "", ())}

    def inserted(best):
        out = dict(best)
        for _ in range(2):
            for state, (cost, audit, left) in list(out.items()):
                new, name = ("u", "user") if state in "nsa" else ("a", "assistant")
                way = (cost + 3, audit + "I", (*left, f"{name}:"))
                out[new] = min(out.get(new, way), way)
        return out

    for role, text, must_go, cut in rows:
        after = {}
        for state, (cost, audit, left) in inserted(best).items():
            new, name = ("u", "user") if state in "nsa" else ("a", "assistant")
            ways = [(state, (cost + 4, audit + "D", left))]
            if not must_go:
                more = 3 * cut
                ways.append((new, (cost + more + 3, audit + "R", (*left, f"{name}:{text}"))))
                if role[:1] == new or role[:1] == "s" and state == "n":
                    ways.append((role[:1], (cost + more, audit + "K", (*left, f"{role}:{text}"))))
            for q, way in ways:
                after[q] = min(after.get(q, way), way)
        best = after
    return min(w for q, w in inserted(best).items() if q in "na")


def plain(turns, search=cheapest):
    """conv_id -> the result columns."""
    out = {}
    for conv_id in {t[0] for t in turns}:
        own = [(t[1], t[2] if t[2] is not None else " ", t[3] if t[3] is not None else " ")
               for t in turns if t[0] == conv_id]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, rows, counts = set(), [], [0, 0, 0, 0, 0]
        for k, (_, role, text) in enumerate(own):
            end = text.rstrip(WHITE)[-1:]
            blank, again, cut = end == "", (role, text) in seen, end not in (".", "!", "?")
            seen.add((role, text))
            counts[1 if blank else 2 if again else 3] += blank or again or cut
            if k and own[k - 1][1][:1] + role[:1] not in ("su", "ua", "au"):
                counts[4] += 1
            rows.append((role, text, blank or again, cut))
        known = [t[0] for t in own if t[0] is not None]
        counts[0] = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, left = search(rows)
        out[conv_id] = (*counts, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def result(spark, turns):
    table = spark.createDataFrame([(*t, None, None, None, None) for t in turns], KINDS)
    return {r[0]: tuple(r[1:]) for r in repair.repair_conversations(table).collect()}


def test_states_agree_with_all_edit_strings():
    draw = random.Random(2)
    for n in range(5):
        for roles in itertools.islice(itertools.product(["system", "user", "assistant", "x"], repeat=n), 200):
            rows = [(r, str(k), draw.random() < 0.2, draw.random() < 0.3) for k, r in enumerate(roles)]
            assert paths(rows) == cheapest(rows)


@pytest.mark.parametrize("seed", range(3))
def test_search_keeps_only_what_is_unsettled(seed):
    """The search alone, row by row, against whole strings; nothing settled is still held."""
    draw = random.Random(seed)
    for _ in range(300):
        rows = [(draw.choice(["system", "user", "assistant", "tool"]), "", draw.random() < 0.2, draw.random() < 0.2)
                for _ in range(draw.randrange(30))]
        search, audit = repair.Search(), ""
        initials = {"s": repair.SYSTEM, "u": repair.USER, "a": repair.ASSISTANT}
        for role, _, must_go, cut in rows:
            search.feed(initials.get(role[0], repair.START), must_go, cut)
            audit += "".join(node.letter for node in search.settled())
            assert search.root.refs > 1 or not search.root.kids
        cost, rest = search.finish()
        want = cheapest(rows)
        assert (cost, audit + "".join(n.letter for n in rest)) == want[:2]


def test_edge_cases(spark):
    draw = random.Random(7)
    turns = []
    for conv_id in [None, *range(60)]:
        for turn in range(draw.randrange(1, 9)):
            role = draw.choice(["system", "user", "assistant", "assistant", "user", "tool", "", None])
            text = draw.choice(["Yes.", "No", "Why? ", "\t\n", "", None, "é!", " ", "Ok.\x0b"])
            turn = draw.choice([turn, turn, turn * 2, None, -3])
            turns += [(conv_id, turn, role, text)] * draw.choice([1, 1, 1, 2, 5])
    turns.append((100, 0, "user", "word " * 200_000))
    assert result(spark, turns) == plain(turns)


def test_long_conversation(spark):
    """Longer than a chunk and than what is handed on at once; a run that settles late."""
    draw = random.Random(9)
    turns = [(1, k, draw.choice(["user", "assistant"]), f"{k}{draw.choice('.,')}") for k in range(3000)]
    turns += [(2, k, "user", f"{k}.") for k in range(900)] + [(3, k, "user", "again") for k in range(1200)]
    turns += [(4, None, "user", "same.")] * 1500
    assert result(spark, turns) == plain(turns)


def test_empty_table(spark):
    assert result(spark, []) == {}
    empty = repair.repair_conversations(spark.createDataFrame([], KINDS))
    assert empty.columns == ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]


def test_repaired_turns(spark):
    """The turns themselves, with other operators' column names beside them."""
    turns = [(5, 0, "system", "Be brief."), (5, 1, "assistant", "Hello."), (5, 2, "assistant", "Hello."), (5, 3, "user", " ")]
    ordered = repair.ordered_turns(spark.createDataFrame([(*t, 1, 1, "x", "y") for t in turns], KINDS))
    rows = repair.repaired_turns(ordered, repair.repair_edits(ordered)).orderBy("pos", "sub").collect()
    assert [(r.edit, r.role, r.text) for r in rows] == [
        ("K", "system", "Be brief."), ("I", "user", ""), ("K", "assistant", "Hello."), ("D", None, None), ("D", None, None)]
