"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import regex

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def lower(text):
    return (text or "").translate(LOWER)


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def exact_groups(rows):
    """(doc_id, keep_id, group_size, sha256) for each (doc_id, text); the largest stays."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    out = []
    for i, text in rows:
        own = groups[lower(text)]
        known = [x for x in own if x is not None]
        out.append((i, max(known) if known else None, len(own),
                    hashlib.sha256(lower(text).encode()).hexdigest()))
    return out


def shingles(text):
    words = space_words(text)
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))}


def join_groups(keys, linked):
    """Smallest reachable key of each key."""
    low = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(low[a], low[b])
            for k in (a, b):
                if low[k] != least:
                    low[k], changed = least, True
    return low


def jaccard_components(rows):
    sets = {i: shingles(text) for i, text in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    low = join_groups(list(sets), links)
    return {i: (len(sets[i]), low[i]) for i in sets}


def mix_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(docs, items, window=10):
    windows = set()
    for item, text in items:
        words = mix_words(text)
        if words:
            for k in range(max(len(words) - window + 1, 1)):
                windows.add((item, tuple(words[k : k + window])))
    out = {}
    for i, text in docs:
        words, hit, found = mix_words(text), set(), set()
        for item, win in windows:
            for k in range(len(words) - len(win) + 1):
                if tuple(words[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(str(item))
        ids = ",".join(sorted(found))
        out[i] = (len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """Share out by weight, again and again, until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out, open_, rest = {}, list(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if rest * weight[s] / total >= epochs * sizes[s]]
        if not full:
            out |= {s: rest * weight[s] / total for s in open_}
            break
        for s in full:
            out[s] = epochs * sizes[s]
        rest -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def base_scores(rows):
    tokens = {i: [*space_words(t), "\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    seen = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(seen.values()), len(seen)
    return {
        i: (held[i], len(ws), sum(seen[w] > 0 for w in ws), n,
            sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for i, ws in tokens.items()
    }


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def preference(chosen, rejected):
    """Prompt, chosen, rejected: lists of (role, text)."""
    k = 0
    while k < min(len(chosen), len(rejected)) and chosen[k] == rejected[k]:
        k += 1
    return chosen[:k], chosen[k:], rejected[k:]


def viterbi(scores, switch):
    best = {k: (s, [k]) for k, s in enumerate(scores[0])}
    for row in scores[1:]:
        best = {
            k: max(((v - switch * (k != j) + s), path + [k]) for j, (v, path) in best.items())
            for k, s in enumerate(row)
        }
    return max(best.values())[0]


def license_scan(text, sentences, rules, gap):
    """(n_sentences, n_matches, licenses, first_position) of one text, from all runs of sentences."""
    if not text:
        return 0, 0, "", None

    def norm(sentence):
        return regex.sub(r"[^\p{L}\p{N}]+", " ", lower(sentence)).strip(" ")

    cut = re.split(r"[\r\n]+|(?<=[.!?:;])[ \t]+", text)
    pieces = [(p, norm(piece)) for p, piece in enumerate(cut) if norm(piece)]
    known = defaultdict(list)
    for name, sentence in sentences.items():
        known[norm(sentence)].append(name)
    most = max((len(x.split()) for x in known), default=0)
    found = defaultdict(set)
    for i in range(len(pieces)):
        for j in range(i, min(i + most, len(pieces))):
            for name in known.get(" ".join(x for _, x in pieces[i : j + 1]), ()):
                found[name].add((pieces[i][0], pieces[j][0]))
    starts = []
    for _, spdx, names in rules:
        for first, last in found[names[0]]:
            ends = {last}
            for name in names[1:]:
                ends = {b for a, b in found[name] if any(e < a <= e + gap + 1 for e in ends)}
            if ends:
                starts.append((first, spdx))
    return (len(cut), len(starts), ",".join(sorted({x for _, x in starts})),
            min((x for x, _ in starts), default=None))
