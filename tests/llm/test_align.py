"""Tokenizer alignment against both tokenizer files read whole and tokens compared pair by pair."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from converge.llm import align

TEXTS = [
    None, "", " ", "\n", "a  b ", "  two  blanks\t\n and\n\nlines ", "it's o'clock, isn't it?", "naïve Größe 日本語 テキスト ไทย", "▁ mark ▁", "<|endoftext|> <s> </s> <0x0A> <unk>", "x" * 300 + " " + "y " * 40,
    "emoji 👩‍👩‍👧 ﬁ Å \u00a0nbsp\u3000wide \x1c sep \x85 next", "12 345 678,90 €", "word\u2028line", "the cat sat on the mat the cat", "the cat sat on the mat the cat", "\x00 zero", "don't" * 30,
]


def plain(texts):
    a_file = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_file.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in letters)}
    b_file = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def sides(text):
        whole = f" {text}".encode()
        a = a_file.encode(f" {text}", add_special_tokens=False)
        b = b_file.encode(text, num_threads=1)
        bytes_a = [bytes(byte_of[c] for c in t) for t in a.tokens]
        bytes_b = [bytes([int(b_file.id_to_piece(i)[3:5], 16)]) if b_file.is_byte(i) else b_file.id_to_piece(i).replace("▁", " ").encode() for i in b]
        return (list(zip(a.ids, bytes_a, strict=True)), list(zip(b, bytes_b, strict=True))) if b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [])

    found = []
    for text in texts:
        a, b = sides(text) if text else ([], [])
        ends = [np.cumsum([len(x) for _, x in s], dtype=int).tolist() for s in (a, b)]
        starts = [[0, *e[:-1]] for e in ends]
        links = [(a[i][0], b[j][0]) for i in range(len(a)) for j in range(len(b)) if max(starts[0][i], starts[1][j]) < min(ends[0][i], ends[1][j])]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [tuple([t for (t, _), e in zip(s, es, strict=True) if lo < e <= hi] for s, es in zip((a, b), ends, strict=True)) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        found.append((len(a), len(b), groups, links))
    counts = Counter(p for *_, links in found for p in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    text_of = lambda groups: hashlib.sha256(";".join("|".join(",".join(map(str, s)) for s in g) for g in groups).encode()).hexdigest() if groups else ""
    return [(na, nb, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), text_of(groups)) for na, nb, groups, links in found], counts


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def rows_of(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_equals_tokens_compared_pair_by_pair(spark, block_bytes):
    wanted, counts = plain(TEXTS)
    rows, pairs = align.align(table(spark, TEXTS), block_bytes=block_bytes)
    assert rows_of(rows) == dict(enumerate(wanted))
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == counts
    assert wanted[8][0] == 0 and wanted[5][0] > 0 and wanted[16][0] > 0


def test_documents(spark, rows):
    texts = [t for _, t, *_ in rows if len(t) < 1000]
    wanted, _ = plain(texts)
    assert rows_of(align.align(table(spark, texts))[0]) == dict(enumerate(wanted))


def test_very_long_texts(spark):
    texts = [" " * 1_000_000 + "x", "\n" * 1_000_000, "ab" * 500_000, "日本" * 200_000, "word " * 300_000]
    got = rows_of(align.align(table(spark, texts))[0])
    for k, text in enumerate(texts):
        a, b = align.Aligner().encode_a(f" {text}"), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")).encode(text)
        assert got[k][:2] == (len(a), len(b)) and got[k][3] == got[k][0] + got[k][1] - got[k][2]


def test_two_pointers():
    a, b, both = align.merged(np.array([2, 3, 7]), np.array([1, 3, 5, 6, 7]))
    assert list(zip(a.tolist(), b.tolist(), both.tolist(), strict=True)) == [(0, 0, False), (0, 1, False), (1, 1, True), (2, 2, False), (2, 3, False), (2, 4, True)]


def test_no_piece_crosses_a_cut():
    assert not any(b" " in t.lstrip(b" ") for t in align.Aligner().bytes_b)


def test_odd_rows(odd, empty):
    got = [(r.doc_id, r.n_a > 0) for r in align.align(odd)[0].collect()]
    assert sorted(got, key=repr) == sorted([(None, True), (None, False), (5, True), (5, True), (5, True), (9, False), (9, False), (2, True)], key=repr)
    rows, pairs = align.align(empty)
    assert rows.count() == 0 and pairs.count() == 0
