"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def components(docs, percent=75):
    """Smallest reachable id of each (id, text), ids being distinct."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    where = {}
    for i in sorted(sets):
        for j, shared in Counter(j for s in sets[i] for j in where.get(s, ())).items():
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def _covered(tokens, width, first, doc_id):
    gone = [False] * len(tokens)
    for s in range(len(tokens) - width + 1):
        if first.setdefault(tuple(tokens[s : s + width]), doc_id) < doc_id:
            gone[s : s + width] = [True] * width
    return gone


def suffix_spans(docs, width=50):
    first, out = {}, {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        gone = _covered(b, width, first, i)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), sum(g and not h for g, h in zip(gone, [False, *gone], strict=False)), hashlib.sha256(kept).hexdigest())
    return out


def word_spans(docs, width=13):
    first, out = {}, {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        w = words(t)
        gone = _covered(w, width, first, i)
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    return out


def edited(docs):
    """The edited text of each document: its second half from the start of the next one, ids falling."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        t, half = t or "", len(t or "") // 2
        out[i] = t[: len(t) - half] + (after or "")[:half]
    return out
