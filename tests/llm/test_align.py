"""Cross-tokenizer alignment against a plain version with the libraries' own tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stationflow.llm import align
from stationflow.llm.common import ship

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

PARTS = [" ", "  ", "\n", "▁", "a", "the", "été", "日本", "\x00", "\t", "</s>", "<|endoftext|>", "😀", "x" * 300, "1", "é́", " ", "　", " ", "\u0085",
         "�", "don't", " 's", ".", " " * 40]
FIGURES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def brute_alignment(rows):
    a_lib = tokenizers.Tokenizer.from_file(public_tokenizers.path(align.A_NAME))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.B_NAME))
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
    docs, held = [], Counter()
    for doc_id, text in rows:
        links, shown, a_ids, b_ids = Counter(), [], [], []
        if text:
            e = a_lib.encode(" " + text, add_special_tokens=False)
            a_ids, a_bytes = e.ids, [bytes(byte_of[c] for c in t) for t in e.tokens]
            b_ids = b_lib.encode(text)
            names = [b_lib.id_to_piece(i) for i in b_ids]
            b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, names, strict=True)]
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ids, b_ids, a_bytes, b_bytes = [], [], [], []
            ends = []
            for tokens in (a_bytes, b_bytes):
                at, end = 0, {}
                for i, t in enumerate(tokens):
                    at += len(t)
                    end[at] = i + 1
                ends.append(end)
            i = j = 0
            for k in sorted(ends[0].keys() & ends[1].keys()):
                a, b = a_ids[i : ends[0][k]], b_ids[j : ends[1][k]]
                i, j = ends[0][k], ends[1][k]
                shown.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
                links.update((x, y) for x in a for y in b)
        docs.append((doc_id, len(a_ids), len(b_ids), len(shown), hashlib.sha256(";".join(shown).encode()).hexdigest() if a_ids else "", links))
        held.update(links.keys())
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return sorted(
        ((d, na, nb, ng, sum(ln.values()), sha, sum(m for p, m in ln.items() if held[p] == best[p[0]]), sum(m * held[p] for p, m in ln.items()))
         for d, na, nb, ng, sha, ln in docs), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    made = [(10 + i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 30)))) for i in range(500)]
    # null, empty, a marker in the text, repeated rows, a shared id, a null id, a text without common ends for long, a long text
    return [(1, None), (2, ""), (3, " "), (4, "▁"), (5, "a b"), (5, "a b"), (5, "c d"), (None, "  a "), (6, "ก" * 5000), (7, "many words, here. " * 5000), *made]


@pytest.mark.parametrize("most", [align.HEAD, 50, 0])
def test_alignment_equals_brute_force(spark, rows, most):
    """With all pairs in the sent table, with some, and with none of them."""
    ship(spark)
    got = align.align_documents(spark.createDataFrame(rows, "doc_id long, text string"), most=most).select(FIGURES).collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment(rows)


def test_counts_of_a_large_group_need_no_expansion(monkeypatch):
    """A group's distinct ids with their numbers give the same pairs as its tokens do."""
    ones = np.ones(10, np.int64)
    a, b = np.array([1, 1, 2, 5]), np.array([3, 3, 4, 9])
    off = np.array([0, 4])
    sizes = ones.copy(), ones.copy()
    sizes[0][5], sizes[1][9] = 2, 2  # both rows have 5 bytes
    sizes[0][1], sizes[1][3] = 1, 1
    found = []
    for big in (align.BIG, 1):
        monkeypatch.setattr(align, "BIG", big)
        found.append([x.tolist() for x in align.Groups(a, b, off, off, *sizes, 5).pairs()])
    assert found[0] == found[1]


def test_empty_table_and_clashing_columns(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, pairs int, n_a int")
    assert align.align_documents(df.limit(0)).count() == 0
    assert align.align_documents(df).select(FIGURES).collect()[0][:5] == (1, 2, 2, 2, 2)
    kept = align.align(df, ["pairs", "n_a", "doc_id"])
    assert kept.columns == ["pairs", "n_a", "doc_id", "_n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_pairs", "times"]
    assert kept.collect()[0][:4] == (3, 4, 1, 2)
