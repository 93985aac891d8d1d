"""Importance resampling against the same rules in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from converge.llm import common, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return [zlib.crc32(f.encode()) % 10_000 for f in runs], len(words)


def plain(docs, target):
    """doc_id -> n_features, weight, score, rank, of (id, text) with distinct ids."""
    made = {i: features(t) for i, t in docs}
    s = Counter(b for f, _ in made.values() for b in f)
    t = Counter(b for x in target for b in features(x)[0])
    s_all, t_all = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    out = {}
    for i, (f, _) in made.items():
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((i for i, (_, n) in made.items() if n >= 20), key=lambda i: (-out[i][2], i))
    for k, i in enumerate(able[: 25 * len(able) // 100]):
        out[i][3] = k + 1
    return {i: tuple(v) for i, v in out.items()}


def rows_of(df):
    return {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in df.collect()}


@pytest.mark.parametrize("share", [3, 500])
def test_equals_plain_version(spark, docs, rows, share, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    target = [rows[40][1], "One two THREE", None, "", rows[60][1] * 3]
    got = resample.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    wanted = plain([(i, t) for i, t, *_ in rows], target)
    assert rows_of(got) == wanted
    assert sum(v[3] is not None for v in wanted.values()) > 10


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    some = " ".join(f"w{k}" for k in range(30))
    monkeypatch.setattr(resample, "noise", lambda doc_id, seed: doc_id % 2)
    table = spark.createDataFrame([(i, some) for i in range(41)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r["rank"] for r in resample.resample(table, table.limit(1)).collect()}
    assert {i for i, r in got.items() if r} == set(range(1, 20, 2)) and [got[i] for i in range(1, 20, 2)] == list(range(1, 11))


def test_features_of_long_and_odd_words():
    texts = ["", "é" * 400 + " b", "a" * 100_000, "x-y_z`{ ÀÉ\x80 9:", "one", "a b " * 20_000, "w" * 48 + " " + "v" * 49 + " " + "u" * 48]
    data = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, data)])
    found, of, words = resample.feature_buckets(common.lower_ascii(np.frombuffer(b"".join(data), np.uint8)), off)
    for k, t in enumerate(texts):
        wanted, n = features(t)
        assert Counter(found[of == k].tolist()) == Counter(wanted) and words[k] == n


def test_odd_rows(odd, empty, spark):
    target = spark.createDataFrame([("w1 w2",)], "text string")
    got = resample.resample(odd, target, percent=100, least_words=1).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted([None, None, 5, 5, 5, 9, 9, 2], key=repr)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 6)) and all(r.weight == 0 for r in got if not r.n_features)
    assert resample.resample(empty, target).count() == 0
    assert all(r.n_features >= 0 for r in resample.resample(odd, empty).collect())
