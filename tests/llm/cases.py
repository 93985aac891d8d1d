"""Small tables with copies, near copies, shared passages, empty and very long texts, and letters of several scripts."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(n=120, seed=5):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéßñlorst") for _ in range(r.randrange(2, 9))) for _ in range(300)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    texts = []
    for k in range(n):
        kind = r.random()
        if texts and kind < 0.15:
            texts.append(r.choice(texts))
        elif texts and kind < 0.35:
            w = (r.choice(texts) or "x").split(" ")
            w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        elif kind < 0.5:
            texts.append(" ".join([r.choice(vocabulary), passage[r.randrange(40) :], r.choice(vocabulary)]))
        else:
            texts.append(r.choice([" ", "\n", "  \t"]).join(r.choice(vocabulary) for _ in range(r.randrange(1, 90))))
    texts[3:3] = ["", "   ", "one", "One two THREE four", "a" * 40_000, " ".join(vocabulary * 20), "日本語 の テキスト", "12 34 ---"]
    return [(i * 3 + 1, t, r.choice(["en", "fr"]), r.choice(["hot", "hot", "b", "c"]), len(t)) for i, t in enumerate(texts)]
