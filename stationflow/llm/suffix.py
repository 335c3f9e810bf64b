"""Exact substring dedup with a logarithmic family of suffix arrays.

Every byte that is covered by a ``LENGTH``-byte string which also starts
earlier in the corpus (smaller doc_id, or the same document further left) is
removed. Strings are judged on the input.

Not every suffix is kept apart: equal ``LENGTH``-byte strings hold the same
anchor, the ``GRAM``-byte string of smallest hash in them, so suffixes are first
gathered under anchors, a run of neighbouring suffixes for each (about one row
for 35 bytes of text).

1. Runs are dealt by their anchor. Runs with the same whole context (all bytes
   that their suffixes' first ``LENGTH`` bytes cover) hold equal suffixes: all
   but the first are removed whole. Copies within a batch are settled before
   the shuffle. A run whose anchor occurs nowhere else is unique and done.
2. What is left, first runs whose anchor also has other contexts (the ends of
   shared passages), is taken suffix by suffix, dealt by the fingerprint of the
   suffix's first ``LENGTH`` bytes. Each task reads its suffixes in corpus order,
   batch by batch, into a family of suffix arrays: a new batch is sorted, is
   merge-scanned against every level for suffixes that agree in ``LENGTH``
   bytes, and becomes a level of its own; levels of equal size merge, so a task
   keeps a logarithmic number of sorted arrays.

   An anchor with more than ``HOT`` contexts (the ends of a line that a large part
   of the corpus shares) does not send them to one task: their suffixes are dealt
   one by one, by their own fingerprints, after equal ones of a batch are settled.

A suffix's place in an array is the 128-bit fingerprint of its first ``LENGTH``
bytes: in any order in which equal beginnings are neighbours, a merge scan finds
all matches of that length.

Defined results: a null text is empty; texts of fewer than ``LENGTH`` bytes
lose nothing; rows that share a doc_id are ordered by the hash of their text,
further copies of a whole row lose all they have if it is ``LENGTH`` bytes or
more; null doc_ids come last; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import numbered, raw_texts, utf8
from stationflow.session import materialize

LENGTH, GRAM = 100, 32
HOT = 100_000  # contexts of an anchor that one task may read
SEGMENT = 1 << 20  # bytes hashed together
POSITION_BITS = 21
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of two polynomial hashes
_BYTES = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:8], "little") for b in range(256)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(codes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of the ``size`` codes from each place, by joining windows of doubled size."""
    have, width, done = codes, 1, None
    done_width = 0
    while True:
        if size & width:
            if done is None:
                done, done_width = have, width
            else:
                n = len(have) - done_width
                done = done[:n] * np.uint64(pow(base, width, 1 << 64)) + have[done_width : done_width + n]
                done_width += width
        if width * 2 > size:
            return done
        n = len(have) - width
        have = have[:n] * np.uint64(pow(base, width, 1 << 64)) + have[width : width + n]
        width *= 2


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while width * 2 <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Powers:
    """Powers of the first base and of its inverse, for hashes of slices of a segment."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SEGMENT + LENGTH)
            cls.up, cls.down = (cls._table(b, size) for b in (BASES[0], pow(BASES[0], -1, 1 << 64)))
        return cls.up[:n], cls.down[:n]

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
        return out[:n]


def runs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of all texts in a batch: (text, first suffix, number of suffixes, anchor hash, context hash)."""
    texts, starts, sizes, anchors, contexts = [], [], [], [], []
    a, total = 0, int(off[-1])
    lead = LENGTH - GRAM + 1  # places a window's anchor may have
    while a + LENGTH <= total:
        b = min(total, a + SEGMENT)
        codes = _BYTES[buf[a:b]]
        gram = _mix(_grams(codes, GRAM, BASES[0]))
        keyed = (gram & ~np.uint64((1 << POSITION_BITS) - 1)) | np.arange(len(gram), dtype=np.uint64)
        anchor = (_sliding_min(keyed, lead) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        n = b - a - LENGTH + 1
        place = np.arange(a, a + n)
        doc = np.searchsorted(off, place, side="right") - 1
        inside = place + LENGTH <= off[doc + 1]
        place, doc, anchor = place[inside] - a, doc[inside], anchor[:n][inside]
        if len(place):
            new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(place, prepend=-2) != 1) | (np.diff(doc, prepend=-1) != 0))
            size = np.diff(new, append=len(place))
            up, down = Powers.get(b - a)
            upto = np.zeros(b - a + 1, np.uint64)
            np.cumsum(codes * up, out=upto[1:])
            begin, end = place[new], place[new] + size + LENGTH - 1
            context = _mix((upto[end] - upto[begin]) * down[begin] + size.astype(np.uint64))
            texts.append(doc[new])
            starts.append(begin + a - off[doc[new]])
            sizes.append(size)
            anchors.append(gram[anchor[new]])
            contexts.append(context)
        a += n
    if not texts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    return tuple(np.concatenate(x) for x in (texts, starts, sizes, anchors, contexts))


# ------------------------------------------------------------------ documents and their keys
KEYS = "no_id boolean, id bigint, hash bigint"
_KEYS = ["no_id", "id", "hash"]
_ZIP = 3  # zstandard level of texts on their way through a shuffle


def _keyed(docs: DataFrame) -> DataFrame:
    """(no_id, id, hash, copy, text): the order of rows in the corpus; hash and copy matter only where ids repeat."""
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return docs.select(
            F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
            F.lit(0).cast("bigint").alias("hash"), F.lit(1).alias("copy"), "text",
        )
    rows, keys = numbered(docs.select("doc_id", "text"))
    return rows.select(*(F.col(k).alias(n) for k, n in zip(keys, [*_KEYS, "copy"], strict=True)), "text")


def _packed(rows: DataFrame) -> DataFrame:
    """The keyed rows with their texts compressed, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=_ZIP).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(map(pack, raw_texts(b.column(4))), pa.binary())], names=[*_KEYS, "copy", "packed"])

    return rows.mapInArrow(run, f"{KEYS}, copy int, packed binary")


def _with_texts(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    lists = lists.toDF(*(f"l_{c}" for c in lists.columns))
    on = [F.col(k) == F.col(f"l_{k}") for k in _KEYS]
    return _packed(rows).join(lists, on, how).drop(*(f"l_{k}" for k in _KEYS))


# ------------------------------------------------------------------ 1: runs under their anchors
_RUN = ["anchor", "context", *_KEYS, "first", "n"]


def _settle(no_id, ids, hashes, found) -> list[np.ndarray]:
    """Columns of ``_RUN`` for a batch. Of equal runs the first stays; the others are settled (negative n) under any key."""
    text, first, n, anchor, context = found
    keys = [no_id[text], ids[text], hashes[text], first]
    both = _mix(anchor * np.uint64(3) + context)
    order = np.argsort(both, kind="stable")
    same = both[order[1:]] == both[order[:-1]]
    rows = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]  # those with an equal
    n = n.copy()
    keep = np.ones(len(n), bool)
    if len(rows):
        rows = rows[np.lexsort([k[rows] for k in (*keys[::-1], context, anchor)])]
        again = (anchor[rows[1:]] == anchor[rows[:-1]]) & (context[rows[1:]] == context[rows[:-1]])
        lead = np.maximum.accumulate(np.where(np.concatenate(([True], ~again)), np.arange(len(rows)), 0))
        later = rows[1:][again]
        head = rows[lead[1:][again]]
        itself = np.logical_and.reduce([k[later] == k[head] for k in keys])  # a repeated row is the same occurrence
        keep[later[itself]] = False
        gone = later[~itself]
        n[gone] = -n[gone]
        anchor = anchor.copy()
        anchor[gone] = _mix(gone.astype(np.uint64) + both[gone] + ids[text[gone]].astype(np.uint64) * np.uint64(5))
    return [c[keep] for c in (anchor.view(np.int64), context.view(np.int64), *keys, n)]


def _all_runs(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 2000):
                b = batch.slice(a, 2000)
                keys = [c.to_numpy(zero_copy_only=False) for c in b.columns[:3]]
                columns = _settle(*keys, runs(*utf8(b.column(3))))
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_RUN)

    return rows.select(*_KEYS, "text").mapInArrow(run, f"anchor bigint, context bigint, {KEYS}, first bigint, n int")


def _judge_runs(found: DataFrame) -> DataFrame:
    """(keys, first, n, anchor): settled and repeated runs with a null anchor; first runs that share their anchor, with it.

    Runs come sorted by anchor, context and corpus order, so one pass tells all;
    it holds a batch and one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        names = [*_KEYS, "first", "n", "anchor"]
        last = None  # (anchor, context, first run of the context, whether the anchor's first run waits)
        for b in batches:
            anchor, context, no_id, ids, hashes, first, n = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            gone = n < 0
            out = [[no_id[gone], ids[gone], hashes[gone], first[gone], -n[gone], np.zeros(gone.sum(), np.int64)]]
            named = [np.zeros(gone.sum(), bool)]
            anchor, context, no_id, ids, hashes, first, n = (c[~gone] for c in (anchor, context, no_id, ids, hashes, first, n))
            if len(n):
                if last is not None:  # the row that waits stands before the batch
                    anchor, context, no_id, ids, hashes, first, n = (np.concatenate(([v], c)) for v, c in zip(last[0], (anchor, context, no_id, ids, hashes, first, n), strict=True))
                carried = last is not None
                new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
                new_context = new_anchor | np.concatenate(([True], context[1:] != context[:-1]))
                lead = np.maximum.accumulate(np.where(new_context, np.arange(len(n)), 0))
                columns = [no_id, ids, hashes, first, n, anchor]
                again = ~new_context & ~np.logical_and.reduce([c[lead] == c for c in (no_id, ids, hashes, first)])
                out.append([c[again] for c in columns])
                named.append(np.zeros(again.sum(), bool))
                # a context that does not begin its anchor opens itself and the anchor's first one
                group = np.cumsum(new_anchor) - 1
                other = new_context & ~new_anchor
                shared = np.bincount(group[other], minlength=group[-1] + 1) > 0
                told = np.zeros(len(n), bool)
                told[0] = carried and last[1]
                open_rows = (new_context & shared[group]) & ~told
                if carried and last[2]:  # the carried row is a later context: its anchor is shared already
                    open_rows[(group == 0) & new_context & ~told] = True
                out.append([c[open_rows] for c in columns])
                named.append(np.ones(open_rows.sum(), bool))
                # carry the last context's first run; whether it is told, and whether its anchor is known to be shared
                k = lead[-1]
                known = bool(shared[group[-1]]) or (carried and last[2] and group[-1] == 0)
                last = ([c[k] for c in (anchor, context, no_id, ids, hashes, first, n)], bool(open_rows[k] or told[k]), known)
            flat = [np.concatenate(c) for c in zip(*out, strict=True)]
            nulls = ~np.concatenate(named)
            arrays = [pa.array(c, t) for c, t in zip(flat[:5], types, strict=False)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(flat[5], pa.int64(), mask=nulls)], names=names)

    sorted_runs = found.repartition("anchor").sortWithinPartitions("anchor", "context", *_KEYS, "first")
    return sorted_runs.mapInArrow(run, f"{KEYS}, first bigint, n int, anchor bigint")


# ------------------------------------------------------------------ 2: the index family
class Family:
    """Sorted arrays of distinct suffixes; sizes grow geometrically."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def _scan(level: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the sorted (a, b) the level holds."""
        at = np.searchsorted(level[0], a)
        found = np.zeros(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            live = live[at[live] < len(level[0])]
            live = live[level[0][at[live]] == a[live]]
            hit = level[1][at[live]] == b[live]
            found[live[hit]] = True
            live = live[~hit]
            at[live] += 1
        return found

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which suffixes of the batch (in corpus order) have an equal one before them; the others join the family."""
        order = np.lexsort((b, a))  # stable: equal suffixes stay in corpus order
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
        known = np.zeros(len(a), bool)
        for level in self.levels:
            known |= self._scan(level, a, b)
        seen = np.empty(len(order), bool)
        seen[order] = ~new | known[np.cumsum(new) - 1]
        self.levels.append((a[~known], b[~known]))
        while len(self.levels) > 1 and len(self.levels[-1][0]).bit_length() >= len(self.levels[-2][0]).bit_length():
            (x, y), (p, q) = self.levels.pop(), self.levels.pop()
            at = np.searchsorted(p, x)
            self.levels.append((np.insert(p, at, x), np.insert(q, at, y)))
        return seen


def suffix_prints(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first and second fingerprint) of every suffix of ``LENGTH`` bytes and more, in order."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    codes = _BYTES[np.frombuffer(b"".join(contexts), np.uint8)]
    counts = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(contexts)), counts)
    at = np.repeat(np.cumsum(sizes) - sizes, counts) + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return of, _mix(_grams(codes, LENGTH, BASES[0]))[at], _mix(_grams(_mix(codes), LENGTH, BASES[1]))[at]


_CONTEXT = ["key", *_KEYS, "first", "context"]


def _one_by_one(rows: list[tuple]) -> list[tuple]:
    """The suffixes of hot runs as runs of one, under their own fingerprints; of equal ones all but the first are settled (no context)."""
    of, x, y = suffix_prints([r[5] for r in rows])
    place = np.arange(len(of)) - np.searchsorted(of, of)
    no_id, ids, hashes, first = (np.array([r[k] for r in rows])[of] for k in (1, 2, 3, 4))
    order = np.lexsort((first + place, hashes, ids, no_id, y, x))
    again = np.zeros(len(of), bool)
    again[order[1:]] = (x[order[1:]] == x[order[:-1]]) & (y[order[1:]] == y[order[:-1]])
    spread = _mix(x + np.arange(len(of), dtype=np.uint64))
    key = np.where(again, spread, x).view(np.int64)
    out = []
    for i, (r, p, k, seen) in enumerate(zip(of.tolist(), place.tolist(), key.tolist(), again.tolist(), strict=True)):
        run = rows[r]
        out.append((k, run[1], run[2], run[3], run[4] + p, None if seen else run[5][p : p + LENGTH]))
    return out


def _open_contexts(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """(key, keys, first, context): the bytes of each run that is still open, to be dealt by ``key``."""
    runs_left = marks.filter("anchor IS NOT NULL")
    hot = runs_left.groupBy("anchor").count().filter(F.col("count") > HOT).select(F.col("anchor").alias("h"))
    runs_left = runs_left.join(hot, F.col("anchor") == F.col("h"), "left").withColumn("hot", F.col("h").isNotNull())
    opened = runs_left.groupBy(*_KEYS).agg(F.collect_list(F.struct("first", "n", "anchor", "hot")).alias("open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for a in range(0, len(batch), 500):
                out: list[tuple] = []
                split: list[tuple] = []
                for no_id, i, h, packed, todo in zip(*(c.to_pylist() for c in batch.slice(a, 500).columns), strict=True):
                    text = unpack(packed)
                    for r in todo:
                        context = text[r["first"] : r["first"] + r["n"] + LENGTH - 1]
                        (split if r["hot"] else out).append((r["anchor"], no_id, i, h, r["first"], context))
                out += _one_by_one(split) if split else []
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=_CONTEXT)

    texts = _with_texts(rows.filter("copy = 1"), opened, "inner").select(*_KEYS, "packed", "l_open")
    return texts.mapInArrow(run, f"key bigint, {KEYS}, first bigint, context binary")


def _match_suffixes(contexts: DataFrame) -> DataFrame:
    """(keys, first, n): stretches of suffixes with an equal one earlier in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family()
        for batch in batches:
            settled = batch.column(4).is_null()
            done = batch.filter(settled)
            yield pa.RecordBatch.from_arrays([*done.columns[:4], pa.array(np.ones(len(done), np.int32))], names=[*_KEYS, "first", "n"])
            b = batch.filter(pc.invert(settled))
            if not len(b):
                continue
            of, x, y = suffix_prints([c.as_py() for c in b.column(4)])
            seen = family.add(x, y)
            place = np.arange(len(of)) - np.searchsorted(of, of)
            begin = np.flatnonzero(seen & ~(np.concatenate(([False], seen[:-1])) & (place > 0)))
            stop = np.flatnonzero(seen & ~(np.concatenate((seen[1:], [False])) & np.concatenate((place[1:] > 0, [False]))))
            row = pa.array(of[begin])
            first = b.column(3).to_numpy()[of[begin]] + place[begin]
            yield pa.RecordBatch.from_arrays(
                [*(c.take(row) for c in b.columns[:3]), pa.array(first), pa.array((stop - begin + 1).astype(np.int32))], names=[*_KEYS, "first", "n"]
            )

    dealt = contexts.repartition("key").sortWithinPartitions(*_KEYS, "first")
    return dealt.select(*_KEYS, "first", "context").mapInArrow(run, f"{KEYS}, first bigint, n int")


# ------------------------------------------------------------------ removal
def cut(text: bytes, first: list[int], n: list[int]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed spans, and what is left, given stretches of removed suffixes."""
    spans: list[list[int]] = []
    for a, k in sorted(zip(first, n, strict=True)):
        b = a + k + LENGTH - 1
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    ends = [0, *(x for s in spans for x in s), len(text)]
    return [(a, b) for a, b in spans], b"".join(text[ends[i] : ends[i + 1]] for i in range(0, len(ends), 2))


def removals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keyed rows, and (keys, first, n): all stretches of suffixes to remove."""
    rows = _keyed(docs)
    marks = materialize(_judge_runs(_all_runs(rows.filter("copy = 1"))), "suffix-marks")
    matched = _match_suffixes(_open_contexts(rows, marks))
    return rows, marks.filter("anchor IS NULL").drop("anchor").unionByName(matched)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document (and its kept bytes, ``with_text``)."""
    rows, gone = removals(docs)
    lists = gone.groupBy(*_KEYS).agg(F.collect_list("first").alias("first"), F.collect_list("n").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for a in range(0, len(batch), 500):
                out = []
                for no_id, i, copy, packed, first, n in zip(*(c.to_pylist() for c in batch.slice(a, 500).columns), strict=True):
                    text = unpack(packed)
                    if copy > 1 and len(text) >= LENGTH:  # a further copy of a whole row
                        first, n = [0], [len(text) - LENGTH + 1]
                    spans, kept = cut(text, first or [], n or [])
                    out.append((None if no_id else i, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    texts = _with_texts(rows, lists, "left").select("no_id", "id", "copy", "packed", "l_first", "l_n")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    found = texts.mapInArrow(run, schema)
    return found if with_text else found.drop("kept")
