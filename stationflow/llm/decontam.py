"""Benchmark decontamination: prefix-filtered set join with exact containment.

A benchmark item is the set of its shingles: windows of ``WINDOW`` consecutive
words (an item of fewer words is one window). A document contains a window only
if it holds every word of it, so one necessary prefix token is enough for
containment 1: the window's rarest word, by counts over all documents (ties by
the word). The join then is:

1. count the benchmark's words over every document;
2. order each window's words by rarity and index the window under its prefix
   token, with that token's place inside the window;
3. in each document, look up the prefix tokens; length and positional bounds
   drop places where the window would not fit; the remaining words are compared
   from the rarest on, until the whole item-sized window is verified.

Both passes are narrow maps over the documents. The index of a block of items
is sent to the tasks; a block holds about ``BLOCK_CHARS`` bytes of items (a longer
item goes in pieces that overlap by a window less a word), so what is sent is
bounded however large the benchmark is: more blocks are further passes, whose
hits are united. Candidates are verified ``CANDIDATES`` at a time, so a long text
of few distinct words, all of them prefix tokens, takes no more memory.

Defined results: null and empty texts have no words, no hits; null and empty
items have no windows; repeated items with one item_id count once; a null
item_id is hit, but not listed; repeated documents each get a row; without
items nothing is contaminated.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.common import carried, raw_texts, thrifty

WINDOW = 10
BLOCK_CHARS = 16_000_000
CANDIDATES = 1 << 18  # places to verify at a time
# lower-cases A-Z; every byte that is no digit, no letter and below 0x80 becomes a space
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class WindowIndex:
    """Windows of a block of items under their prefix tokens.

    Held in arrays: about 60 bytes for each distinct window, and as much again
    while it is built.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], counts: dict[bytes, int], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        names: dict[str | None, int] = {}
        found, owners = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int32)]
        for name, text in items:
            own = np.array([self.ids.setdefault(w, len(self.ids)) for w in words_of(text)], np.int32)
            if len(own):
                short = np.pad(own, (0, max(0, window - len(own))), constant_values=-1)
                found.append(np.lib.stride_tricks.sliding_window_view(short, window))
                owners.append(np.full(len(found[-1]), names.setdefault(name, len(names)), np.int32))
        self.names = list(names)
        windows, which = np.unique(np.concatenate(found), axis=0, return_inverse=True)
        owned = np.unique(np.stack([which.ravel(), np.concatenate(owners)], axis=1), axis=0)
        self.item_of = owned[:, 1].astype(np.int32)  # items of window w: item_of[item_at[w] : item_at[w + 1]]
        self.item_at = np.searchsorted(owned[:, 0], np.arange(len(windows) + 1))
        self.size = (windows >= 0).sum(axis=1)
        by_rarity = sorted(self.ids.items(), key=lambda x: (counts.get(x[0], 0), x[0]))
        rank = np.full(len(self.ids) + 1, len(self.ids), np.int32)  # the last: no word
        rank[np.array([i for _, i in by_rarity], np.int64)] = np.arange(len(by_rarity))
        # words of each window from the rarest on, and their places; short windows repeat their first
        place = np.argsort(rank[windows], axis=1, kind="stable").astype(np.int16 if window < 1 << 15 else np.int32)
        self.place = np.where(np.arange(window) < self.size[:, None], place, place[:, :1])
        self.order = np.take_along_axis(windows, self.place.astype(np.int64), axis=1)
        self.under = np.argsort(self.order[:, 0], kind="stable")
        bounds = np.searchsorted(self.order[self.under, 0], np.arange(len(self.ids) + 1))
        self.first, self.many = bounds[:-1], np.diff(bounds)

    def items(self, window: int) -> np.ndarray:
        return self.item_of[self.item_at[window] : self.item_at[window + 1]]

    def hits(self, ids: np.ndarray, doc_first: np.ndarray, doc: np.ndarray, together: int = CANDIDATES) -> tuple[np.ndarray, np.ndarray]:
        """(start place, window) of every occurrence in the concatenated word ids of a batch.

        Candidates (an occurrence of a word, a window under it) are made and
        verified ``together`` at a time, however many there are. Of those that
        stay, a place has one for each window size at most.
        """
        starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        known = np.flatnonzero(ids >= 0)
        known = known[self.many[ids[known]] > 0]
        ends = np.cumsum(self.many[ids[known]])
        for a in range(0, int(ends[-1]) if len(ends) else 0, together):
            number = np.arange(a, min(a + together, int(ends[-1])))
            which = np.searchsorted(ends, number, side="right")
            at = known[which]
            nth = number - (ends[which] - self.many[ids[at]])
            window = self.under[self.first[ids[at]] + nth]
            start = at - self.place[window, 0]
            own = doc[at]
            fits = (start >= doc_first[own]) & (start + self.size[window] <= doc_first[own + 1])  # positional and length bounds
            start, window = start[fits], window[fits]
            for k in range(1, self.order.shape[1]):
                same = ids[start + self.place[window, k]] == self.order[window, k]
                start, window = start[same], window[same]
            starts.append(start)
            windows.append(window)
        return np.concatenate(starts), np.concatenate(windows)


def _count_words(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """Occurrences, over all documents, of the words of a block of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in raw_texts(batch.column(0)):
                total.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], names=["w", "n"])

    counted = docs.select("text").mapInArrow(thrifty(run), "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    return {bytes(r.w): r.n for r in counted.toLocalIterator()}  # at most the block's own words


def _pieces(text: bytes, most: int, window: int) -> Iterator[bytes]:
    """The text, or, if it is longer than ``most``, pieces that have the same windows between them."""
    if len(text) <= most:
        yield text
        return
    piece, size, new = [], 0, 0
    for w in words_of(text):
        piece.append(w)
        size, new = size + len(w) + 1, new + 1
        if size > most and len(piece) >= window:
            yield b" ".join(piece)
            piece = piece[len(piece) - window + 1 :]
            size, new = sum(map(len, piece)) + len(piece), 0
    if new:
        yield b" ".join(piece)


def _blocks(items: DataFrame, most: int, window: int = WINDOW) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of about ``most`` bytes, dealt by hash (identical rows once); a longer item goes in pieces."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    n = max(1, -(-2 * total // most))
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        block, size = [], 0
        for r in part.toLocalIterator():
            for piece in _pieces(r.text.encode(), most, window):
                if block and size + len(piece) > most:
                    yield block
                    block, size = [], 0
                block.append((r.item_id, piece))
                size += len(piece)
        yield block


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("hit_from", T.ArrayType(T.IntegerType())), T.StructField("hit_to", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])
ARROW = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _mark(texts: list[bytes], index: WindowIndex) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """(number of words, hit word spans, items) of each text."""
    get = index.ids.get
    per_doc = [[get(w, -1) for w in words_of(t)] for t in texts]
    counts = np.array([len(x) for x in per_doc], np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))
    ids = np.concatenate([np.array(x, np.int32) for x in per_doc]) if texts else np.zeros(0, np.int32)
    doc = np.repeat(np.arange(len(texts)), counts)
    start, window = index.hits(ids, first, doc)
    out = [(int(n), [], set()) for n in counts]
    for s, w in zip(start.tolist(), window.tolist(), strict=True):
        d = int(doc[s])
        a = s - int(first[d])
        out[d][1].append((a, a + int(index.size[w])))
        out[d][2].update(index.names[i] for i in index.items(w) if index.names[i] is not None)
    return out


def find_contamination(docs: DataFrame, items: DataFrame, keep: list[str], window: int = WINDOW, block_chars: int = BLOCK_CHARS, out: list[str] | None = None) -> DataFrame:
    """``keep`` columns of the documents with n_words, n_hit, the hit word spans and the items found (named ``out``)."""
    found, at = carried(docs, keep)
    fields = list(found.schema)
    k = len(fields)
    names = [f.name for f in RESULT]
    blocks = 0
    for block in _blocks(items, block_chars, window):
        vocabulary = frozenset(w for _, text in block for w in words_of(text))
        index = WindowIndex(block, _count_words(docs, vocabulary), window)
        sent = docs.sparkSession.sparkContext.broadcast(index)
        later = blocks > 0

        def run(batches: Iterator[pa.RecordBatch], sent=sent, later=later) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _mark(raw_texts(batch.column(at)), sent.value)
                if later:  # unite with what earlier blocks of items have hit
                    before = zip(*(batch.column(k + j).to_pylist() for j in (2, 3, 4)), strict=True)
                    rows = [(n, s + list(zip(a, b, strict=True)), i | set(c)) for (n, s, i), (a, b, c) in zip(rows, before, strict=True)]
                spans = [_union(s) for _, s, _ in rows]
                values = [
                    [n for n, _, _ in rows], [sum(b - a for a, b in s) for s in spans], [[a for a, _ in s] for s in spans],
                    [[b for _, b in s] for s in spans], [sorted(i, key=str.encode) for _, _, i in rows],
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:k], *(pa.array(v, t) for v, t in zip(values, ARROW, strict=True))], names=[*(f.name for f in fields), *names]
                )

        found = found.mapInArrow(thrifty(run), T.StructType([*fields, *RESULT]))
        blocks += 1
    return found.select(*(f"k{i}" for i in range(len(keep))), *names).toDF(*keep, *(out or names))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = find_contamination(docs, items, ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
