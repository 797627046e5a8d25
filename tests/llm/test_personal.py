"""Personal data against plain regular expressions and a plain bootstrap."""

import math
import random
import re
from collections import defaultdict

import pyarrow.parquet as pq

from docquay.llm import personal_data as personal
from docquay.llm.queries import QUERIES
from tests.conftest import SF_DIR

KINDS = ("email", "ip", "card", "phone")
# The patterns as the task states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WHITE = "\x20\x09-\x0D"


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    return sorted((m.start(), n, m.end()) for n, k in enumerate(KINDS)
                  for m in re.finditer(PLAIN[k], text or "") if valid(k, m.group()))


def words(context):
    plain = re.sub("[1-9]", "0", context.lower())
    return [w for w in re.split(f"[{WHITE}]+", plain) if w]


def uses(text):
    """(start, end, kind or None, instance, patterns) of seeds and other tokens."""
    text = text or ""
    seeds, out = base(text), []

    def add(at, end, kind, value, before, after):
        l, r = ["^", "^", *words(before)][-2:], [*words(after), "^"][0]
        out.append((at, end, kind, value.lower(), (f"{l[0]} {l[1]} _", f"{l[1]} _ {r}")))

    for n, k in enumerate(KINDS):
        spans = [m.span() for m in re.finditer(PLAIN[k], text)]
        for i, (a, b) in enumerate(spans):
            low, high = (spans[i - 1][1] if i else 0), (spans[i + 1][0] if i + 1 < len(spans) else len(text))
            if (a, n, b) in seeds:
                add(a, b, n, text[a:b], text[max(low, a - 64):a], text[b:min(high, b + 64)])
    spans = [m.span() for m in re.finditer(f"[^{WHITE}]+", text) if re.search("[0-9@]", m.group())]
    for i, (a, b) in enumerate(spans):
        low, high = (spans[i - 1][1] if i else 0), (spans[i + 1][0] if i + 1 < len(spans) else len(text))
        alnum = [k for k in range(a, b) if text[k].isalnum()]
        first = min([k for k in range(a, b) if text[k].isalnum() or text[k] in "+@"])
        last = max([first, *alnum]) + 1
        value = text[first:last]
        if len(re.sub("[^0-9]", "", value)) < 4 and "@" not in value:
            continue
        if not any(s < last and e > first for s, _, e in seeds):
            add(first, last, None, value, text[max(low, a - 64):a], text[b:min(high, b + 64)])
    return out


def discovered(texts, rounds=personal.ROUNDS):
    """Per text the spans of discovered instances."""
    every = [uses(t) for t in texts]
    known, pairs = {}, defaultdict(set)
    for own in every:
        for _, _, kind, value, patterns in own:
            if kind is not None:
                known[value] = (min(kind, known.get(value, (9,))[0]), 1.0)
            for p in patterns:
                pairs[p].add(value)
    found = {}
    for _ in range(rounds):
        good = {}
        for p, values in pairs.items():
            for n in range(4):
                score = sum(known[v][1] for v in values if v in known and known[v][0] == n) / (len(values) + 1)
                if score >= personal.PATTERN_SCORE:
                    good[p, n] = score
        votes = defaultdict(list)
        for (p, n), score in good.items():
            for v in pairs[p]:
                if v not in known:
                    votes[v, n].append(score)
        new = {}
        for (v, n), scores in votes.items():
            conf = 1 - math.prod(1 - s for s in scores)
            if conf >= personal.INSTANCE_SCORE and (v not in new or (conf, -n) > (new[v][1], -new[v][0])):
                new[v] = (n, conf)
        found |= new
        if not new:
            break
        known |= new
    return [sorted({(a, found[v][0], b) for a, b, kind, v, patterns in own
                    if kind is None and v in found and any((p, found[v][0]) in good for p in patterns)})
            for own in every]


def result(spark, texts):
    # Names that the operator uses inside, and a repeated and a missing identifier.
    rows = [(k, t, 1, "x", "y", 0.5) for k, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, kind long, base string, pattern string, conf double")
    found = personal.personal_data(table)
    assert found.columns == ["doc_id", "base", "found"]
    got = {r.doc_id: ([tuple(s) for s in r.base], [tuple(s) for s in r.found]) for r in found.collect()}
    return [got[k] for k in range(len(texts))]


def test_base_spans(spark):
    draw = random.Random(3)
    parts = ["a@b.c", "a.b+c%d@e-f.gh", "@", "a@b", ".c", "_x@y.z", "@p.q", "1.2.3.4", "0001.255.00.09", "256.1.1.1",
             "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "4111111111111111", "4111111111111112", "+1 (555) 010-2345",
             "+49.30.1234567", "+1", "+", "  ", " ", "-", "é", "😀", "\n", "\t", "12", "x", "..", "(5)", "0" * 30, "€", "\x85"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(25))) for _ in range(1500)]
    # The plain patterns take the square of these lengths.
    texts += ["", None, " ", "a" * 5000, "1" * 5000, "1 " * 5000, "a@b.c " * 5000, "+" * 5000,
              "😀" * 1000 + "a@b.c", "1." * 5000, "a@" * 5000, "+1" + " " * 5000]
    got = result(spark, texts)
    for text, (spans, _) in zip(texts, got):
        assert spans == base(text), text


def prose(seed):
    draw = random.Random(seed)
    plain = ["lorem", "ipsum", "dolor", "sit", "amet", "consetetur"]

    def line():
        return [draw.choice(plain) for _ in range(6)]

    texts = []
    for k in range(100):
        near = draw.choice(["write to", "reach me", "my mail"])
        address = f"u{k}@host{k}.example.com" if k % 9 else f"u{k}(at)host{1000 + k}"
        texts.append(" ".join([*line(), near, address + draw.choice([",", "", "."]), "or", *line()]))
        number = f"+1 (555) 0{100 + k}-{2000 + k}" if k % 8 else f"555-0{100 + k}-{2000 + k}"
        texts.append(" ".join([*line(), "call us on", number, "today", *line()]))
        texts.append(" ".join([*line(), "in the year", str(1900 + k), *line()]))
    # Only patterns that the second round trusts say what these are.
    texts += [f"fallback desk: 555-0{100 + k}-{2000 + k} always" for k in range(0, 100, 8)]
    texts += ["fallback desk: 777-8888-99 always", "fallback desk: lunch always", "in the year 2024"]
    return texts + [texts[0], None, ""]


def test_discovery(spark):
    texts = prose(1)
    got, want = result(spark, texts), discovered(texts)
    assert [f for _, f in got] == want
    named = {t[a:b] for t, spans in zip(texts, want) for a, _, b in spans}
    assert "u0(at)host1000" in named and "777-8888-99" in named
    assert not any(re.fullmatch("[0-9]{4}", v) for v in named)


def test_no_rows_and_nothing_to_find(spark):
    assert result(spark, []) == []
    assert result(spark, ["nothing here", None, ""]) == [([], [])] * 3
    one = spark.createDataFrame([(None, "a@b.cc"), (3, "a@b.cc"), (3, "a@b.cc")], "doc_id long, text string")
    assert [len(r.base) for r in personal.personal_data(one).collect()] == [1, 1, 1]


def test_query(spark):
    texts = dict(zip(*pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
    found = dict(zip(texts, discovered(list(texts.values()))))
    rows = QUERIES["op12_personal_data"][0](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = sorted(base(texts[r.doc_id]) + found[r.doc_id])
        assert r.spans == ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        own = [k for _, k, _ in base(texts[r.doc_id])]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [own.count(n) for n in range(4)]
