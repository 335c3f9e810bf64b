"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stationflow.llm import variants
from stationflow.llm.common import ship

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}
COLUMNS = ["word", "n", "form", "form_n", "root", "n_near"]


def brute_variants(rows):
    count = Counter()
    for doc_id, text in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                count[w] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    gaps, near = defaultdict(list), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in gaps.values():
        for a in same:
            near[a].update(b for b in same if b != a)
    form = {}
    for w in words:
        if near[w]:
            f = min(near[w], key=lambda x: (-words[x], x))
            if words[f] >= 10 * words[w]:
                form[w] = f

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, words[w], form.get(w), words.get(form.get(w)), root(w), len(near[w])) for w in words)


def made_rows():
    rnd = random.Random(3)
    base = ["abcdefg", "abcdefgh", "aaaaaaaa", "Été" * 3, "×÷ÀÿÀÿÀ", "Internationalisierung", "x" * 200, "zyxwvut"]

    def changed(w):
        k, r = rnd.randrange(len(w)), rnd.random()
        new = rnd.choice("abcdéÿzX")
        return w if r < 0.4 else w[:k] + w[k + 1 :] if r < 0.6 else w[:k] + new + w[k:] if r < 0.8 else w[:k] + new + w[k + 1 :]

    rows = [(1, None), (2, ""), (None, "abcdefgh abcdefghi"), (3, "abcdefgh"), (3, "abcdefgh"), (4, "y" * 100_000 + " " + "y" * 100_000), (5, "y" * 99_999), (6, "y" * 99_999)]
    for i in range(600):
        words = [changed(rnd.choice(base)) if rnd.random() < 0.5 else base[int(rnd.random() ** 4 * 8)] for _ in range(rnd.randint(1, 60))]
        rows.append((10 + i, " ".join(words) + rnd.choice(["", " ", "日", "ê"])))
    return rows


@pytest.fixture(scope="module")
def rows():
    return made_rows()


def test_variants_equal_brute_force(spark, rows):
    ship(spark)
    want = brute_variants([r for r in rows if not (r[1] or "").startswith("y" * 9)])
    small = spark.createDataFrame([r for r in rows if not (r[1] or "").startswith("y" * 9)], "doc_id long, text string")
    got = sorted(tuple(r) for r in variants.variants(small).select(COLUMNS).collect())
    assert got == want
    assert any(r[2] is not None and r[4] != r[2] for r in want)  # chains of several forms are among them


def test_very_long_words(spark, rows):
    ship(spark)
    long = [r for r in rows if (r[1] or "").startswith("y" * 9)]
    got = variants.variants(spark.createDataFrame(long * 2, "doc_id long, text string")).select("n", "n_near", "form").collect()
    assert sorted(r.n_near for r in got) in ([1, 1], [0, 0]) and sum(r.n for r in got) == 8


def test_several_passes_give_the_same_pairs(spark, rows, monkeypatch):
    """Filters of more blocks than one piece holds take several passes and lose no pair."""
    ship(spark)
    words = sorted({w.lower() for _, t in rows for w in RUN.findall(t or "") if 7 <= len(w) <= 30})
    vocabulary = spark.createDataFrame([(w.encode("latin-1"), 2) for w in words], "word binary, n long")
    one = {tuple(map(bytes, r)) for r in variants.near_pairs(vocabulary).select("word", "near").collect()}
    monkeypatch.setattr(variants, "CHUNK", 14)
    monkeypatch.setattr(variants.Shards, "__init__", many_blocks)
    several = [tuple(map(bytes, r)) for r in variants.near_pairs(vocabulary, piece_blocks=1 << 14).select("word", "near").collect()]
    assert set(several) == one and len(several) == len(one) > 100


def many_blocks(self, sizes):
    self.first, self.blocks, at = {}, {}, 0
    for shard in sorted(sizes):
        self.first[shard], self.blocks[shard] = at, 7000
        at += 7000
    self.total = at


def test_edit_hash_is_the_hash_of_the_edited_word():
    alphabet = np.frombuffer(bytes(range(97, 123)), np.uint8)
    points = np.array([list(b"abcdefg"), list(b"zzzzzzz")], np.uint8)
    power = variants._powers(7)
    h = variants._SALT[points] * power

    def plain(w):
        return (variants._SALT[np.frombuffer(w, np.uint8)] * variants._powers(len(w))).sum(dtype=np.uint64)

    row, place, gone = variants._deletions(points, h)
    assert (row == 1).sum() == 1  # equal neighbours: one deletion
    for r, p, x in zip(row, place, gone, strict=True):
        w = points[r].tobytes()
        assert plain(w[:p] + w[p + 1 :]) == x
    made = 0
    for cell, new, x in variants._replacements(points, h, alphabet):
        for c, k, y in zip(cell.tolist(), new.tolist(), x, strict=True):
            w = bytearray(points[c // 7].tobytes())
            assert alphabet[k] > w[c % 7]
            w[c % 7] = alphabet[k]
            made += 1
            assert plain(bytes(w)) == y
    assert made == sum(25 - i for i in range(7))


def test_crc_of_prefix_and_word():
    words = pa.array(["étrange", "abcdefgh", "étrange"]).cast(pa.binary())
    latin = pa.array([w.as_py().decode().encode("latin-1") for w in words], pa.binary()).dictionary_encode()
    got = variants._slips(latin, np.array([7, 8, 7]), np.array([0, 1, 2]), [b"1:", b":", b"123:"])
    assert got.tolist() == [zlib.crc32(p + w.as_py()) for p, w in zip([b"1:", b":", b"123:"], words, strict=True)]


def test_empty_table_and_extra_columns(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "lettering Lettering", "x", 2)], "doc_id long, text string, word string, n int")
    assert variants.variants(df.limit(0)).count() == 0
    got = variants.variants(df, slip_mod=1 << 31).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == [("lettering", 2, None, None, "lettering", 0)]
