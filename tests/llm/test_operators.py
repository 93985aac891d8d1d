"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

from __future__ import annotations

import functools
import hashlib
import random
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from converge.llm import common, exact, langid, lm, minhash, mixing, packing, repeats, substring, suffix, toxicity, winnow

CASES = [
    lambda d: minhash.near_duplicates(d), lambda d: exact.exact_dedup(d), lambda d: winnow.fingerprints(d), lambda d: winnow.compare_with_next(d), lambda d: suffix.repeated_spans(d),
    lambda d: substring.repeated_spans(d), lambda d: lm.score(d, *lm.fit(d, rounds=1)), lambda d: toxicity.score(d, toxicity.Grammar([])), lambda d: langid.identify(d, langid.fit(d)), lambda d: packing.pack(d), lambda d: mixing.mix(d),
]


@pytest.mark.parametrize("operator", range(len(CASES)))
def test_nulls_ties_and_repeated_rows(operator, odd):
    ids = sorted((r.doc_id for r in CASES[operator](odd).select("doc_id").collect()), key=repr)
    assert ids == sorted([None, None, 5, 5, 5, 9, 9, 2], key=repr)


@pytest.mark.parametrize("operator", range(len(CASES)))
def test_empty_tables(operator, empty):
    assert CASES[operator](empty).count() == 0


def test_near_duplicates(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    wanted = plain.components([(i, t) for i, t, *_ in rows])
    assert got == {i: (n, c, c == i) for i, (n, c) in wanted.items()}
    assert {r.doc_id for r in minhash.keep_one(docs).collect()} == {i for i, (_, c) in wanted.items() if c == i}


def test_super_minhash_estimates_similarity():
    r = np.random.RandomState(1)
    base = r.randint(1, 1 << 62, 600).astype(np.uint64)
    sets = [np.unique(base[:400]), np.unique(base[100:500])]
    a, b = minhash.super_minhash(sets, 512)
    assert abs((a == b).mean() - 300 / 500) < 0.06
    assert np.isinf(minhash.super_minhash([np.zeros(0, np.uint64)], 8)).all()


def test_odd_near_duplicates(odd):
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert got == {(None, None, True), (5, 2, False), (9, 9, True), (2, 2, True)}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup(docs, rows, keep):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    best = min if keep == "smallest" else max
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_dedup(docs, keep=keep).collect()}
    assert got == {i: (best(groups[t]), len(groups[t]), best(groups[t]) == i, hashlib.sha256(t.encode()).hexdigest()) for i, t, *_ in rows}


def test_hot_texts_are_dealt_over_salts(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact.exact_dedup(df, keep="largest", hot_share=3).where("text_sha256 = sha2('hot', 256)").agg(F.min("keep_id"), F.max("keep_id"), F.min("group_size"), F.count_if("kept"), F.count("*")).first()
    assert tuple(got) == (2997, 2997, 1000, 1, 1000)


def test_exact_dedup_keeps_one_of_each(odd):
    kept = exact.keep_one(odd).collect()
    assert sorted((r.text or "") for r in kept) == sorted({"", "other text", *(r.text for r in odd.collect() if r.text)})
    assert kept[0].asDict().keys() == set(odd.columns)


@pytest.fixture(scope="module")
def clashing(odd):
    names = ("_own", "_time", "_source", "_whole", "_cut", "_dropped", "_row", "_of", "_carry", "_digest", "_salt", "_start", "row", "null", "source_size", "target", "kept", "component_id", "epochs", "k", "n", "a", "b", "p", "_score", "score", "shard", "x.y")
    return odd.withColumns({c: F.lit(i) for i, c in enumerate(names)})


KEEPERS = [lambda d: exact.keep_one(d), lambda d: minhash.keep_one(d), lambda d: mixing.mixed(d), lambda d: toxicity.keep_clean(d, toxicity.Grammar([]))]


@pytest.mark.parametrize("keeper", range(len(KEEPERS)))
def test_stages_keep_all_columns_whatever_their_names(keeper, clashing):
    out = KEEPERS[keeper](clashing)
    assert out.dtypes == clashing.dtypes
    whole = {repr(r) for r in clashing.collect()}
    got = [repr(r) for r in out.collect()]
    assert got and set(got) <= whole
    # Null ids stay in near deduplication; a repeated row is one of a group of equal texts.
    n = {0: 4, 1: 5, 3: 8}.get(keeper)
    assert n is None or len(got) == n
    assert KEEPERS[keeper](clashing.limit(0)).count() == 0
    assert KEEPERS[keeper](clashing.limit(0)).columns == clashing.columns


def test_stages_handle_texts_over_a_step(spark):
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(400_000))
    assert len(long) > common.STEP_BYTES
    rows = [(1, long), (2, long), (3, long + " and one more"), (4, "short"), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in exact.keep_one(docs).collect()) == [1, 3, 4, 5]
    assert sorted(r.doc_id for r in minhash.keep_one(docs).collect()) == [1, 4, 5]
    assert {r.doc_id: r.size for r in mixing.mix(docs).select("doc_id", "size").collect()} == {1: 400_000, 2: 400_000, 3: 400_003, 4: 1, 5: 0}
    assert sorted(r.doc_id for r in toxicity.keep_clean(docs, toxicity.Grammar([])).collect()) == [1, 2, 3, 4, 5]
    assert {r.doc_id: r.n_removed for r in substring.repeated_spans(docs).collect()} == {1: 0, 2: 400_000, 3: 400_000, 4: 0, 5: 0}


def test_keys_of_light_sources_fall_into_many_bins(spark):
    for weight in (0.05, 0.25, 1.0):
        keys = spark.range(200_000).select(mixing._key(F.col("id"), F.lit(weight), "s").alias("k"))
        assert keys.distinct().count() == 200_000
        most = keys.groupBy(F.floor(F.log("k") * mixing.BINS)).count().agg(F.max("count")).first()[0]
        assert most < 2 * 200_000 / mixing.BINS / np.e


def test_exact_dedup_runs_no_python(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    plan = exact.exact_dedup(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_fingerprints(docs, rows):
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    k, w = 5, 4
    for r in winnow.fingerprints(docs, k=k, window=w).collect():
        b = texts[r.doc_id]
        h = [int(common.range_hashes(common.byte_values(np.frombuffer(b, np.uint8)), np.array([s]), np.array([min(s + k, len(b))]))[0]) >> 32 for s in range(max(1, len(b) - k + 1))][:500] if b else []
        chosen = []
        for s in range(max(1, len(h) - w + 1)) if h else []:
            least = min(h[s : s + w])
            at = max(p for p in range(s, min(s + w, len(h))) if h[p] == least)
            if at not in chosen:
                chosen.append(at)
        n = len(chosen) if len(b) < 500 else len(chosen) - 1
        assert list(zip(r.hashes, r.positions, strict=True))[:n] == [(h[p], p) for p in chosen][:n]


def test_equal_passages_share_a_fingerprint():
    r = random.Random(2)
    for _ in range(50):
        shared = bytes(r.randrange(97, 123) for _ in range(winnow.K + winnow.WINDOW - 1))
        a, b = (bytes(r.randrange(97, 123) for _ in range(r.randrange(80))) + shared + bytes(r.randrange(97, 123) for _ in range(30)) for _ in range(2))
        data = np.frombuffer(a + b, np.uint8)
        doc, h, _ = winnow.chosen(data, np.array([0, len(a), len(a) + len(b)]))
        assert set(h[doc == 0]) & set(h[doc == 1])


def test_edited_texts(docs, rows):
    wanted = plain.edited([(i, t) for i, t, *_ in rows])
    got = {r.doc_id: r for r in winnow.compare_with_next(docs).collect()}
    assert {i: r.edited_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in wanted.items()}
    by_text = {}
    for i, t, *_ in rows:
        assert got[i].n_chars == len(t or "")
        assert by_text.setdefault(t or "", got[i].fingerprint) == got[i].fingerprint
    # Fingerprints written out window by window, and what two of them share.
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda d: -d[0])
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        own, changed, other = (plain_fingerprint(x) for x in (t, wanted[i], after))
        assert [p for _, p in own] == got[i].positions and "".join(f"{h:08x}" for h, _ in own) == got[i].fingerprint
        for near, x in ((got[i].near_edited, changed), (got[i].near_next, other)):
            a, b = {h for h, _ in own}, {h for h, _ in x}
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


@functools.cache
def plain_fingerprint(text, k=winnow.K, w=winnow.WINDOW):
    b = text.encode()
    if not b:
        return []
    data, n = np.frombuffer(b, np.uint8), max(1, len(b) - k + 1)
    h = [int(x) >> 32 for x in common.range_hashes(common.byte_values(data), np.arange(n), np.minimum(np.arange(n) + k, len(b)))]
    found = []
    for s in range(max(1, n - w + 1)):
        least = min(h[s : s + w])
        at = max(p for p in range(s, min(s + w, n)) if h[p] == least)
        if not found or found[-1][1] != at:
            found.append((least, at))
    return found


def test_suffix_dedup(docs, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in suffix.repeated_spans(docs).collect()}
    assert got == plain.suffix_spans([(i, t) for i, t, *_ in rows])


@pytest.mark.parametrize(("threshold", "gram"), [(7, 3), (12, 12), (20, 4)])
def test_suffix_dedup_at_other_depths(docs, rows, threshold, gram):
    short = docs.where("length(text) < 1000")
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in suffix.repeated_spans(short, threshold=threshold, gram=gram).collect()}
    assert got == plain.suffix_spans([(i, t) for i, t, *_ in rows if len(t) < 1000], threshold)


@pytest.mark.parametrize("hot", [1, 4, 32])
def test_windows_of_frequent_grams_meet_one_by_one(docs, rows, hot):
    short = docs.where("length(text) < 1000")
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in suffix.repeated_spans(short, hot=hot, home_bytes=4000).collect()}
    assert got == plain.suffix_spans([(i, t) for i, t, *_ in rows if len(t) < 1000])


@pytest.mark.parametrize("depth", [3, 8, 19])
def test_radix_passes_bring_equal_suffixes_together(depth):
    r = np.random.RandomState(depth)
    data = np.concatenate([r.randint(0, 2, 3000), np.tile(r.randint(0, 256, 40), 30), np.zeros(depth)]).astype(np.uint8)
    starts, values = r.permutation(len(data) - depth)[:3500], r.randint(0, 1000, 3500)
    least = {}
    for s, v in zip(starts.tolist(), values.tolist(), strict=True):
        key = data[s : s + depth].tobytes()
        least[key] = min(v, least.get(key, v))
    assert suffix.least_of_equal(data, starts, values, depth).tolist() == [least[data[s : s + depth].tobytes()] for s in starts.tolist()]
    assert not len(suffix.least_of_equal(data, starts[:0], values[:0], depth))


def test_windows_whose_keys_collide_are_told_apart_by_their_bytes():
    texts = [b"x" + b"a" * 9, b"y" + b"a" * 9, b"x" + b"a" * 9, b"a" * 10, b"z" + b"b" * 9]
    data, n = np.frombuffer(b"".join(texts), np.uint8), len(texts)
    end = np.arange(1, n + 1) * 10
    spans = repeats.Spans(data, end - 10, end, np.zeros(n, np.int64), np.full(n, 4))
    seen = repeats.Seen(np.zeros(n, np.uint64), None, np.array([3, 2, 1, 9, 0]), np.zeros(n, np.uint8), spans)
    for at_a_time in (1, 1 << 20):
        found = suffix.earlier_windows(7, at_a_time)(seen).reshape(n, 4).tolist()
        assert found == [[1, 1, 1, 1], [0, 1, 1, 1], [0, 0, 0, 0], [1, 1, 1, 1], [0, 0, 0, 0]]


def test_substring_dedup(docs, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.repeated_spans(docs).collect()}
    assert got == plain.word_spans([(i, t) for i, t, *_ in rows])


@pytest.mark.parametrize("window", [3, 5])
def test_substring_dedup_of_shorter_windows(docs, rows, window):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.repeated_spans(docs, window=window).collect()}
    assert got == plain.word_spans([(i, t) for i, t, *_ in rows], window)


def test_removal_is_the_same_from_many_small_homes(docs, rows):
    small = {"home_bytes": 2000, "part_bytes": 5000}
    homes, parts = repeats.sizes(docs, "text", **small)
    n = sum(len((t or "").encode()) for _, t, *_ in rows)
    assert (homes, parts) == (-(-n // 2000), -(-n // 5000)) and homes > parts > 8
    texts = [(i, t) for i, t, *_ in rows]
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in suffix.repeated_spans(docs, **small).collect()} == plain.suffix_spans(texts)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.repeated_spans(docs, **small).collect()} == plain.word_spans(texts)


def test_language_model(spark):
    r = random.Random(4)
    known = [f"s{i}" for i in range(30)]
    ordered = [" ".join(known[(s + i) % 30] for i in range(40)) for s in range(300)]
    mixed = [" ".join(r.choice(known) for _ in range(40)) for _ in range(20)]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(ordered * 8)], "doc_id long, text string").repartition(2)
    model = lm.fit(train)
    both = spark.createDataFrame([(0, ordered[5]), (1, mixed[0]), (2, "")], "doc_id long, text string")
    a, b, c = lm.score(both, *model).orderBy("doc_id").collect()
    assert a.mean_log_likelihood > b.mean_log_likelihood + 1
    assert (c.n_tokens, c.log_likelihood, c.mean_log_likelihood) == (0, 0.0, None)


@pytest.mark.parametrize("size", [lm.CLASSES, 700])
def test_language_model_is_normalised(size):
    r = np.random.RandomState(0)
    p, context = lm.start_weights(size=size), r.randint(0, size, (len(lm.OFFSETS), 3))
    total = sum(np.exp(lm.class_log_probabilities(p, context, np.full(3, c))) for c in range(size))
    assert np.allclose(total, 1, atol=1e-4)
    v = lm.Vocabulary(r.randint(0, 50, 1 << lm.BUCKET_BITS))
    assert np.allclose(np.bincount(v.classes, np.exp(v.share), lm.CLASSES)[: lm.PAD], 1, atol=1e-2)


def test_language_model_knows_the_exact_count_of_every_word(spark):
    """Rare words do not share counts, however many there are, and more words are modelled as the corpus grows."""
    texts = [(i, " ".join(f"r{i}x{j}" for j in range(2000))) for i in range(150)] + [(1000 + i, "twice thrice" if i < 2 else "thrice") for i in range(3)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    counts, vocabulary = lm.count(docs.select(F.col("text").alias("_text")))
    assert counts.count() == 150 * 2000 + 2 > 1 << lm.BUCKET_BITS
    assert {r.n: r["count"] for r in counts.groupBy("n").count().collect()} == {1: 150 * 2000, 2: 1, 3: 1}
    assert vocabulary.frequent == lm.modelled(150 * 2000 + 5) == 4 * 547
    assert lm.modelled(4 * 10**10) == 2 * lm.modelled(10**10) > lm.FREQUENT


def test_language_model_adds_the_share_of_joined_words(spark):
    texts = [(i, " ".join(f"w{(i * 7 + j * j) % 997}" for j in range(60))) for i in range(60)]
    texts.append((60, "w5 unseen words w990 w5"))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    vocabulary, p, counts = lm.fit(docs.where("doc_id < 60"))
    n = {r.word: r.n for r in counts.collect()}
    got = {r.doc_id: r for r in lm.score(docs, vocabulary, p, counts).collect()}
    seen = {c: 0.0 for c in range(lm.OTHERS)}
    for i, t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        word, shape, first = lm.words(raw, np.array([0, len(raw)]))
        classes = vocabulary.class_of(word, shape)
        wanted = lm.class_log_probabilities(p, lm.contexts(classes, first, vocabulary.size - 1), classes).sum()
        for w, c in zip(word.tolist(), classes.tolist(), strict=True):
            if c >= vocabulary.frequent:
                wanted += np.log(n.get(w, 0) + 1) + vocabulary.rest[c - vocabulary.frequent]
        assert got[i].n_tokens == len(word) and got[i].log_likelihood == pytest.approx(wanted, rel=1e-5)
    frequent = set(vocabulary.sorted.tolist())
    for r in counts.collect():
        seen[r.shape] += (r.n + 1) * (r.word not in frequent)
    assert np.allclose(np.exp(-vocabulary.rest), np.array(list(seen.values())) + 1)


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_every_word_is_a_target_once(rounds):
    texts = ["a b c d e f g h i j k", "l", "", "m n o p q r s t u v w x y z"]
    vocabulary = lm.Vocabulary(np.zeros(0), np.zeros(0, np.int64), np.ones(lm.OTHERS))
    coded = list(lm._coded(vocabulary)(iter([pa.RecordBatch.from_pydict({"_text": texts, "_h": [1, 2, 3, 4]})])))
    batches = [b.append_column("shard", pa.array([i % 2 for i in range(b.num_rows)], pa.int64())).sort_by("shard") for b in coded]
    seen, step = [], lm._Trainer.step
    lm._Trainer.step = lambda self, context, target: seen.append(len(target))
    try:
        for turn in range(rounds):
            list(lm._train(vocabulary.size, lm.start_weights(size=vocabulary.size), turn, rounds)(iter(batches)))
    finally:
        lm._Trainer.step = step
    assert sum(seen) == 26


def test_the_network_starts_as_plain_counts():
    r = np.random.RandomState(3)
    size = 1000
    counts = r.randint(100, 1000, size).astype(float)
    p, context = lm.start_weights(size=size, counts=counts), r.randint(0, size, (len(lm.OFFSETS), size))
    assert np.allclose(lm.class_log_probabilities(p, context, np.arange(size)), np.log(counts / counts.sum()), atol=0.05)


def test_log_likelihood_against_a_plain_forward_pass():
    """Each word's probability from the tree, a node at a time, for contexts that reach over both ends of a document."""
    r = np.random.RandomState(5)
    size, sides = 1000, range(-lm.SIDE, lm.SIDE + 1)
    classes, first = r.randint(0, size - 1, 11), np.array([0, 4, 4, 11])
    p = {k: v + r.normal(0, 0.2, v.shape).astype(np.float32) for k, v in lm.start_weights(size=size).items()}
    got = lm.class_log_probabilities(p, lm.contexts(classes, first, size - 1), classes)
    nodes, turns, begin, subtree = lm.tree(size)
    for d in range(3):
        for i in range(first[d], first[d + 1]):
            around = [classes[i + o] if first[d] <= i + o < first[d + 1] else size - 1 for o in sides if o]
            h = np.append(np.tanh(np.concatenate([p["e"][c] for c in around]) @ p["w"] + p["b"][0]), 1)
            wanted = p["t"][subtree[classes[i]]] @ h - np.log(np.exp(p["t"] @ h).sum())
            wanted += sum(-np.log1p(np.exp(-turns[k] * (p["v"][nodes[k]] @ h))) for k in range(begin[classes[i]], begin[classes[i] + 1]))
            assert got[i] == pytest.approx(wanted, abs=1e-3)


def test_language_model_is_better_than_counts_and_does_not_depend_on_files(spark):
    r = random.Random(12)
    after = {f"v{i}": [f"v{(i * 7 + j) % 90}" for j in range(3)] for i in range(90)}
    texts = []
    for i in range(1500):
        w = [f"v{r.randrange(90)}"]
        while len(w) < 60:
            w.append(r.choice(after[w[-1]]) if r.random() < 0.9 else f"rare{r.randrange(3000)}" if r.random() < 0.5 else f"v{r.randrange(90)}")
            if w[-1] not in after:
                w.append(f"v{r.randrange(90)}")
        texts.append((i, " ".join(w)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    train, test = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    model = lm.fit(train.repartition(2), shard_words=60)
    again = lm.fit(train.repartition(7), shard_words=60)
    got = {x.doc_id: x for x in lm.score(test, *model).collect()}
    other = {x.doc_id: x.log_likelihood for x in lm.score(test.repartition(5), *again).collect()}
    assert all(x.log_likelihood == pytest.approx(other[i], rel=1e-6) for i, x in got.items())
    count = {}
    for i, t in texts:
        for x in t.split() if i % 5 else ():
            count[x] = count.get(x, 0) + 1
    all_words = sum(count.values()) + len(count) + 1
    held = [x for i, t in texts if i % 5 == 0 for x in t.split()]
    by_counts = sum(np.log((count.get(x, 0) + 1) / all_words) for x in held) / len(held)
    assert sum(x.log_likelihood for x in got.values()) / len(held) > by_counts + 0.3


def test_language_identification(spark):
    r = random.Random(8)
    syllables = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ung", "keit", "ein"], "cc": ["ción", "ado", "los", "que"]}
    text = lambda k, n: " ".join("".join(r.choice(syllables[k]) for _ in range(r.randrange(1, 4))) for _ in range(n))
    train = [(i, text(k, 30), k) for i, k in enumerate(["aa", "bb", "cc"] * 40)]
    model = langid.fit(spark.createDataFrame([*train, (999, "x", None), (1000, None, "aa")], "doc_id long, text string, lang string"))
    tests = [(i, text(k, 4), k) for i, k in enumerate(["aa", "bb", "cc"] * 20)]
    got = {x.doc_id: x for x in langid.identify(spark.createDataFrame([(i, t) for i, t, _ in tests] + [(-1, None), (-2, "12 - 3"), (-3, "")], "doc_id long, text string"), model).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in tests) >= 57
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (-1, -2, -3))


def _segmentations(word, pieces):
    """Every way to write the word as pieces."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in _segmentations(word[n:], pieces):
                yield [word[:n], *rest]


def _by_length(words):
    words = sorted(words, key=len)
    matrix = np.zeros((len(words), len(words[-1])), np.uint8)
    for k, w in enumerate(words):
        matrix[k, : len(w)] = np.frombuffer(w, np.uint8)
    return words, matrix, np.array([len(w) for w in words])


def test_forward_sums_all_segmentations():
    """Random words and pieces, some of more than eight bytes, against every segmentation written out."""
    r = random.Random(3)
    pieces = sorted({b"\x01", b"a", b"b", *(bytes(r.choice(b"ab") for _ in range(n)) for n in (2, 3, 4, 9, 10, 11) for _ in range(4)), *(b"\x01" + bytes(r.choice(b"ab") for _ in range(n)) for n in (1, 2, 9))})
    p = np.array([[r.random(), r.random()] for _ in pieces])
    words, matrix, lengths = _by_length({b"\x01" + bytes(r.choice(b"ab") for _ in range(r.randrange(1, 12))) for _ in range(60)})
    of = {w: k for k, w in enumerate(pieces)}
    segmenter = langid.Segmenter(pieces, p)
    got = segmenter.log_probabilities(matrix, lengths)
    wanted_uses = np.zeros_like(p)
    for k, w in enumerate(words):
        ways = list(_segmentations(w, of))
        each = np.array([np.prod([p[of[x]] for x in way], axis=0) for way in ways])
        assert np.allclose(got[k], np.log(each.sum(axis=0)))
        for way, share in zip(ways, each / each.sum(axis=0), strict=True):
            for x in way:
                wanted_uses[of[x]] += share * (k % 3)
    assert np.allclose(segmenter.expected(matrix, lengths, np.arange(len(words)) % 3.0), wanted_uses)


LONG_WORDS = ["".join(random.Random(4).choice("的一是不了人我在有他这中大来上国日本語のテキスト年月。，") for _ in range(900)), "ภาษาไทยไม่มีช่องว่างระหว่างคำ" * 30, "donaudampfschifffahrtsgesellschaft" * 20, "éñß" * 90 + "a" * 300, "ab" + "語" * 40 + "cd" * 40]


def test_long_words_fall_apart_where_no_piece_reaches_across():
    """Sums and expected uses of long words are those of the whole word, a place at a time and side by side."""
    pieces = langid.vocabulary()
    r = np.random.RandomState(3)
    p = r.dirichlet(np.full(len(pieces), 0.3), 2).T + 1e-7
    segmenter, one = langid.Segmenter(pieces, p), langid.Segmenter(pieces, p[:, :1])
    apart = 0
    for text in LONG_WORDS:
        raw = np.frombuffer(text.encode(), np.uint8)
        off = np.array([0, len(raw)])
        sums, uses = [], []
        for known in ((), tuple(pieces)):
            data, starts, lengths, _, marked = langid._words(raw, off, known)
            total, used, places = np.zeros(2), np.zeros((len(pieces), 1)), 0
            for at, matrix, n in langid._blocks(data, starts, lengths, marked):
                # The same words many times over are worked on side by side.
                many, wide = np.repeat(matrix, langid.FEW, axis=0), np.repeat(n, langid.FEW)
                alone = np.array([segmenter.log_probability(w[:k].tobytes()) for w, k in zip(matrix, n, strict=True)])
                assert np.allclose(segmenter.log_probabilities(many, wide)[:: langid.FEW], alone, rtol=1e-9)
                total += alone.sum(axis=0)
                few, beside = np.zeros((len(pieces), 1)), one.expected(many, wide, np.full(len(many), 1 / langid.FEW))
                for w, k in zip(matrix, n, strict=True):
                    one.expected_of(w[:k].tobytes(), 1.0, few)
                assert np.allclose(few, beside, atol=1e-7)
                used, places = used + few, places + len(at)
            sums.append(total)
            uses.append(used)
            apart += places * (1 if known else -1)
        assert np.allclose(*sums, rtol=1e-9) and np.allclose(*uses, atol=1e-6)
    assert apart > 500


def test_texts_without_spaces_take_a_bounded_time_for_each_byte(spark):
    import time

    texts = [w * (200_000 // len(w)) for w in LONG_WORDS] + ["x" * 1_000_000]
    table = spark.createDataFrame([(k, t, "ab"[k % 2]) for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.fit(table, iterations=1)
    began = time.perf_counter()
    assert langid.identify(table, model).count() == len(texts)
    # 8 microseconds a byte on one core, were each a place of its own; most fall apart.
    assert time.perf_counter() - began < 8e-6 * sum(len(t.encode()) for t in texts) + 10


def test_words_of_any_length_are_scored_whole():
    """A long word against sums in exact arithmetic, a place at a time."""
    from fractions import Fraction

    r = random.Random(5)
    pieces = [b"\x01", b"a", b"ab", b"aba", b"b", b"bbababbab", b"\xc3\xa9", b"\xa9", b"\xc3"]
    p = {w: r.randrange(1, 9) for w in pieces}
    words, matrix, lengths = _by_length([b"\x01" + b"".join(r.choice([b"a", b"b", b"\xc3\xa9", b"bbababbab"]) for _ in range(n)) for n in (3, 40, 300, 700)])
    segmenter = langid.Segmenter(pieces, np.array([[p[w] * 1e-7] for w in pieces]))
    got = segmenter.log_probabilities(matrix, lengths)
    uses = segmenter.expected(matrix, lengths, np.ones(len(words)))
    total = 0.0
    for k, w in enumerate(words):
        alpha = [Fraction(1)]
        for end in range(1, len(w) + 1):
            alpha.append(sum((alpha[end - len(x)] * p[x] / 10**7 for x in pieces if w[:end].endswith(x)), Fraction(0)))
        value = alpha[-1]
        assert got[k, 0] == pytest.approx(_log(value), rel=1e-9)
        total += len(w)
    # The pieces that are used have as many bytes as the words.
    assert sum(u * len(x) for (u,), x in zip(uses, pieces, strict=True)) == pytest.approx(total)


def _log(value):
    return (value.numerator.bit_length() - value.denominator.bit_length()) * np.log(2) + np.log(float(value.numerator >> max(0, value.numerator.bit_length() - 900)) / 2.0 ** (min(value.numerator.bit_length(), 900))) - np.log(float(value.denominator >> max(0, value.denominator.bit_length() - 900)) / 2.0 ** (min(value.denominator.bit_length(), 900)))


def test_grammar():
    g = toxicity.Grammar([toxicity.key_of("moron", whole=False)])
    assert g.paths(["target", "other", "insult"]) == ["target", "other", "insult aimed"]
    assert g.paths(["insult", "target"]) == ["insult aimed", "target"]
    assert g.paths(["negation", "other", "insult", "other", "insult"]) == ["negation", "other", "insult negated", "other", "insult"]
    assert g.paths(["report", "target", "threat"])[-1] == "threat reported"
    assert g.paths(["strong", "insult", "other", "intent", "threat"]) == ["strong", "insult strong", "other", "intent", "threat meant"]
    raw = "You are a moron. He said moron! Moron, you\nI will hurt you? Such a moron; moron moron".encode()
    assert [m[3] for m in g.matches(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))] == ["insult aimed", "insult reported", "insult aimed", "threat meant", "insult strong", "insult"]


def test_threats_are_whole_words_in_their_forms():
    g = toxicity.Grammar([])
    of = lambda text: [m[3] for m in g.matches(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))]
    assert of("killing you now") == ["threat aimed"] and of("I am going to murder you") == ["threat meant"] and of("ich habe ihn erschossen") == ["threat"]
    assert of("they strangled him") == ["threat"] and of("a strangler fig") == of("a stranglehold") == of("the killer app") == []
    assert of("she said he was killed") == ["threat reported"] and of("nobody was not murdered") == ["threat negated"]


def test_grammar_against_a_plain_reading():
    """What each insult and threat of random clauses is, by rules applied to the whole clause, a word at a time."""
    r, g = random.Random(11), toxicity.Grammar([])
    for _ in range(2000):
        clause = [r.choice([*toxicity.SYMBOLS, "other", "other", "insult", "threat"]) for _ in range(r.randrange(1, 12))]
        wanted = []
        for i, s in enumerate(clause):
            near, before, behind = clause[max(0, i - toxicity.GOVERNED) : i], clause[:i], clause[i + 1 :]
            if s not in ("insult", "threat"):
                wanted.append(s)
            elif "negation" in near:
                wanted.append(f"{s} negated")
            elif "report" in before:
                wanted.append(f"{s} reported")
            elif "target" in before:
                wanted.append(f"{s} aimed")
            elif s == "insult" and "strong" in near:
                wanted.append("insult strong")
            elif s == "threat" and "intent" in near:
                wanted.append("threat meant")
            else:
                wanted.append(f"{s} aimed" if "target" in behind else s)
        assert g.paths(clause) == wanted


def test_a_long_tail_of_insults_and_quoted_ones_are_learned(spark):
    """Forty insults that each stand in one of eighty toxic texts, and one that clean texts hold too, but negated or reported."""
    r = random.Random(7)
    filler = [f"w{a}{b}" for a in "bcdfghjk" for b in "aeiou"]
    tail = ["".join(r.choice("klmnprst") + r.choice("aeiou") for _ in range(4)) for _ in range(40)]
    rows, labels = [], []
    for i in range(6000):
        w = [r.choice(filler) for _ in range(15)]
        toxic = i % 5 == 0
        if toxic:
            w[r.randrange(15)] = r.choice(tail) if i % 10 else "quuxard"
        elif i % 3 == 0:
            w[:3] = r.choice([["said", "a", "quuxard"], ["never", "a", "quuxard"]])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    machine = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int").where(~common.held_out("doc_id")))
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    got = {x.doc_id: x.predicted for x in toxicity.score(docs, machine).collect()}
    assert np.mean([got[i] == 1 for i, t in held if t]) > 0.95
    assert np.mean([got[i] == 0 for i, t in held if not t]) > 0.99


def test_toxicity_learns_stems(spark):
    r = random.Random(6)
    common_words = [f"w{a}{b}" for a in "abcdefgh" for b in "xyzuvt"]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(common_words) for _ in range(20)]
        toxic = i % 4 == 0
        if toxic:
            w[r.randrange(20)] = "grumpf" + r.choice(["", "er", "ing", "s"])
            w[r.randrange(20)] = r.choice(["blarg", "blargy"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows.append((1000, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    truth = dict(labels)
    machine = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int").where(~common.held_out("doc_id")))
    got = {x.doc_id: x for x in toxicity.score(docs, machine).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.97
    assert got[1000].predicted == 0
    assert {x.doc_id for x in toxicity.keep_clean(docs, machine).collect()} == {i for i, x in got.items() if x.score < 0.5}


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = packing.pack(docs, capacity=256, group=64).collect()
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t, *_ in rows}
    by_doc, by_sequence = {}, {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for i, whole in ids.items():
        pieces = sorted(by_doc[i], key=lambda p: p.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(whole) // 256)
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(whole[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(whole)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256
    assert len(by_sequence) <= 1.05 * sum(map(len, ids.values())) / 256 + 2


def test_packing_reads_added_tokens_as_the_tokenizer_file_does(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext", "  <|endoftext|>  don't", "plain"]
    got = {p.doc_id: p for p in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID]
        assert (got[i].length, got[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_packing_of_long_blanks(spark):
    """Texts of so many blanks have the ids that the tokenizer file gives, whatever the blanks are."""
    from tokenizers import Tokenizer

    import public_tokenizers

    texts = [f"x{run}y" for run in (" " * 1_200_000, "\n" * 1_200_000, "\t " * 600_000, " \n\t\u00a0" * 300_000)] + [" " * 20_000 + "<|endoftext|>" + "\n" * 9_999 + "z"]
    got = {}
    for p in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got.setdefault(p.doc_id, []).append(p)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID], "<u4")
        assert sum(p.length for p in got[k]) == len(ids)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in got[k])


def test_genetic_packing_is_valid_and_no_worse_than_best_fit():
    r = random.Random(1)
    sizes = [r.randrange(300, 900) for _ in range(200)]
    people = packing._Population(sizes, 2048, 1)
    plain_bins = people.put([], people.longest_first(list(range(200))))
    best = people.evolve([], 40, 6)
    assert sorted(i for b in best for i in b) == list(range(200)) and max(map(people.fill, best)) <= 2048
    assert people.fitness(best) >= people.fitness(plain_bins)


def test_mixing(spark, docs, rows):
    got = mixing.mix(docs, bins=7).collect()
    size = {i: len(plain.words(t)) for i, t, *_ in rows}
    of = {i: s for i, _, _, s, _ in rows}
    sources = sorted(set(of.values()))
    total = {s: sum(n for i, n in size.items() if of[i] == s) for s in sources}
    weights, left, target = dict(zip(sources, [3, 1, 2] * 9, strict=False)), 1.5 * sum(total.values()), {}
    while True:  # sources above their bound stop there, and the rest is shared again
        free = [s for s in sources if s not in target]
        share = left / sum(weights[s] for s in free) if free else 0
        over = [s for s in free if share * weights[s] > 2 * total[s]]
        if not over:
            target |= {s: share * weights[s] for s in free}
            break
        for s in over:
            target[s] = 2 * total[s]
            left -= target[s]
    taken = dict.fromkeys(sources, 0)
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], total[r.source]) and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s in sources:
        assert abs(taken[s] - target[s]) <= max(n for i, n in size.items() if of[i] == s)
    again = mixing.mix(docs.repartition(5), bins=3).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    copies = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.epochs for r in got if r.epochs}


def test_a_pivot_of_many_and_a_hot_bucket(spark):
    """Thousands of edited copies of one text, some near to each other only, against brute force on what they are made of."""
    r = random.Random(21)
    base = [f"b{i}" for i in range(80)]
    rows = [(0, " ".join(base))]
    for i in range(1, 4000):
        w = list(base)
        for at in r.sample(range(80), 1 if i % 3 else 2):
            w[at] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    # Edits of twelve words lie apart from the base, and of these every pair of neighbours shares all but one.
    for i in range(4000, 4040, 2):
        w = list(base)
        for at in range(3, 75, 6):
            w[at] = f"f{i}x{at}"
        rows.append((i, " ".join(w)))
        rows.append((i + 1, " ".join([*w[:-1], "last"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs).collect()}
    alone = [(i, t) for i, t in rows if i == 0 or i >= 4000]
    wanted = {i: c for i, (_, c) in plain.components(alone).items()}
    near = {i for i, t in rows if 0 < i < 4000 and (lambda a, b: 100 * len(a & b) >= 75 * len(a | b))(plain.shingles(t), plain.shingles(rows[0][1]))}
    assert len(near) > 3900
    assert all(got[i] == 0 for i in near) and all(got[i] == c for i, c in wanted.items())


def test_what_stays_apart_is_compared_in_blocks(spark):
    """Chains of edits, whose ends are alike to their neighbours only, with blocks that are smaller than the chains."""
    r = random.Random(9)
    rows = []
    for chain in range(3):
        w = [f"c{chain}w{i}" for i in range(60)]
        for step in range(30):
            rows.append((chain * 100 + step, " ".join(w)))
            w = [*w[2:], f"c{chain}n{step}a", f"c{chain}n{step}b"]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = plain.components(rows)
    size, minhash.BLOCK = minhash.BLOCK, 8
    try:
        got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs).collect()}
    finally:
        minhash.BLOCK = size
    assert got == {i: c for i, (_, c) in wanted.items()}
