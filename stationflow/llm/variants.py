"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

Words. Runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts, A-Z
lower-cased; a run whose crc32 with its document's id is divisible by
``SLIP_MOD`` loses one code point. Counted per 8 MB of text first, then by Spark.
All code points are below 256, so a word is kept as one byte for each.

Filters. The vocabulary is sharded by word length; each shard is a blocked Bloom
filter (a 64-bit block for each word's hash, ``PROBES`` bits in it). Spark builds
the blocks in chunks, and the filters are broadcast in pieces of ``PIECE_BLOCKS``
blocks (32 MB) at most: a larger vocabulary takes more passes, each of which
tests only the edits whose block is in its piece.

Edits. A pair is generated once: a deletion from its longer word, a replacement
from the word with the smaller code point there. So deletions are probed in the
shard of the next shorter words and replacements in a word's own shard, over the
alphabet of the vocabulary itself (at most 116 code points). The hash is a sum
over positions, so the hash of an edit costs a few operations whatever the
word's length. Only edits that the filter lets pass are spelled out and shuffled
to an exact join with the vocabulary, which removes the false ones.

Roots. A form has at least ten times its word's count, so a chain has at most
log10 of the largest count steps, and pointer doubling takes the logarithm of
that many joins.

Memory: a task holds 8 MB of text (or one longer text), or a batch of words, at
most ``CELLS`` edits and one piece of the filter; the driver holds one piece.

Defined results: a null or empty text has no words; a null doc_id counts as an
empty string before the colon; repeated rows and rows that share an id count
each; a word of any length is whole (shards of ``LAST_SHARD`` and more are one);
ties for a form go to the smallest word in code-point order; a word without near
words has no form and is its own root; an empty table gives an empty result;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import raw_texts, utf8
from stationflow.session import materialize

SHORTEST, LEAST = 7, 2  # code points and occurrences of a word
SLIP_MOD, RATIO = 31, 10
TEXT_BYTES = 8 << 20
LAST_SHARD = 64
KEYS_PER_BLOCK, PROBES = 2.5, 4  # words for each 64-bit block on average, bits of a word in it
CHUNK = 14  # blocks of a chunk as a power of two
PIECE_BLOCKS = 4 << 20
CELLS = 1 << 20
HIGH_LEAD = 0xC3  # lead byte of U+00C0 to U+00FF, which leads nothing else

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), HIGH_LEAD]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[0x80:0xC0] += 0x40  # the byte after the lead byte, as its code point


# ---- words and their counts


def _joined(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Stretches of bytes as a binary column."""
    upto = np.concatenate(([0], np.cumsum(size)))
    take = np.repeat(start - upto[:-1], size) + np.arange(upto[-1])
    data = np.ascontiguousarray(buf[take])
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(data)])


@lru_cache(maxsize=64)
def _shifts(n: int) -> np.ndarray:
    """What n further bytes make of a crc32, by byte of the crc (4 x 256)."""
    zeros = bytes(n)
    none = zlib.crc32(zeros)
    bit = np.array([zlib.crc32(zeros, 1 << i) ^ none for i in range(32)], np.uint32)
    table = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for i in range(8):
            table[k] ^= np.where(np.arange(256) >> i & 1, bit[8 * k + i], 0).astype(np.uint32)
    return table


def _runs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of at least ``SHORTEST`` letters: the words' code points as one column, their texts, their code points."""
    letter = _LETTER[buf]
    lead = buf == HIGH_LEAD
    letter[1:] |= lead[:-1]
    edge = np.zeros(len(buf) + 1, bool)  # a text's first byte follows nothing
    edge[off] = True
    before = np.concatenate(([False], letter))
    before[edge] = False
    start = np.flatnonzero(letter & ~before[:-1])
    after = np.concatenate((letter, [False]))
    after[edge] = False
    end = np.flatnonzero(letter & ~after[1:]) + 1
    leads = np.concatenate(([0], np.cumsum(lead)))
    points = end - start - (leads[end] - leads[start])
    long = points >= SHORTEST
    start, points = start[long], points[long]
    # without the lead bytes a word is one byte for each code point
    text = np.searchsorted(off, start, "right") - 1
    return _joined(_LOWER[buf[~lead]], start - leads[start], points), text, points


def _slips(words: pa.DictionaryArray, points: np.ndarray, text: np.ndarray, prefix: list[bytes]) -> np.ndarray:
    """crc32 of each word occurrence behind its document's prefix."""
    values = [v.decode("latin-1").encode() for v in words.dictionary.to_pylist()]
    codes = words.indices.to_numpy()
    size = np.fromiter(map(len, values), np.int64, len(values))[codes]
    own = np.fromiter(map(zlib.crc32, values), np.uint32, len(values))[codes]
    begun = np.fromiter(map(zlib.crc32, prefix), np.uint32, len(prefix))[text]
    crc = np.empty(len(codes), np.uint32)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for at in np.split(order, cuts):
        if len(at):
            t, x = _shifts(int(size[at[0]])), begun[at]
            crc[at] = t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24] ^ own[at]
    return crc


def word_counts(docs: DataFrame, slip_mod: int = SLIP_MOD) -> DataFrame:
    """(word, n) of all words with their occurrences; a word is one byte (ISO 8859-1) for each code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(size // TEXT_BYTES)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                if b > a:
                    part = batch.slice(a, b - a)
                    words, text, points = _runs(*utf8(part.column(1)))
                    words = words.dictionary_encode()
                    crc = _slips(words, points, text, raw_texts(part.column(0)))
                    codes, slip = words.indices.to_numpy(), crc % np.uint32(slip_mod) == 0
                    many = np.bincount(codes[~slip], minlength=len(words.dictionary))
                    seen = np.flatnonzero(many)
                    cut: Counter[bytes] = Counter()
                    values = words.dictionary.take(pa.array(codes[slip])).to_pylist()
                    for v, place in zip(values, (crc[slip] % points[slip]).tolist(), strict=True):
                        if len(v) > SHORTEST:
                            cut[v[:place] + v[place + 1 :]] += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([words.dictionary.take(pa.array(seen)), pa.array(list(cut), pa.binary())]),
                         pa.array(np.concatenate((many[seen], np.array(list(cut.values()), np.int64))), pa.int64())], names=["word", "n"],
                    )

    prefix = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    partial = docs.select(prefix.alias("prefix"), "text").mapInArrow(run, "word binary, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


# ---- the filters


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8(column.cast(pa.binary()))


# a word's hash: the sum over its places i of SALT[code point] * STEP**i, mixed; all modulo 2**64
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SALT = np.cumprod(np.full(256, _STEP ^ np.uint64(0x5DEECE66D), np.uint64) | np.uint64(1))


def _powers(n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(0, n - 1), _STEP))))[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _MIX[0]
    h ^= h >> np.uint64(29)
    h *= _MIX[1]
    return h ^ (h >> np.uint64(32))


def _block(h: np.ndarray, first: int, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64) + first


def _bit(h: np.ndarray, k: int) -> np.ndarray:
    return h >> np.uint64(6 * k) & np.uint64(63)


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the length, the places of its words and their code points (a row for each word)."""
    buf, off = _points(column)
    size = np.diff(off)
    order = np.argsort(size, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(at):
            n = int(size[at[0]])
            rows = max(1, CELLS // (50 * n))
            for a in range(0, len(at), rows):
                some = at[a : a + rows]
                yield n, some, buf[off[some][:, None] + np.arange(n)]


class Shards:
    """Where each length's shard lies in the row of all blocks."""

    def __init__(self, sizes: dict[int, int]):
        self.first, self.blocks, at = {}, {}, 0
        for shard in sorted(sizes):
            self.first[shard], self.blocks[shard] = at, max(1, math.ceil(sizes[shard] / KEYS_PER_BLOCK))
            at += self.blocks[shard]
        self.total = at

    def of(self, length: int) -> tuple[int, int] | None:
        shard = min(length, LAST_SHARD)
        return (self.first[shard], self.blocks[shard]) if shard in self.first else None


def shards_of(vocabulary: DataFrame) -> tuple[Shards, bytes]:
    """The shards (from at most 64 counts) and the code points that occur in the vocabulary."""
    shard = F.least(F.length("word"), F.lit(LAST_SHARD))
    sizes = {r[0]: r[1] for r in vocabulary.groupBy(shard.alias("shard")).count().collect()}

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, bool)
        for b in batches:
            seen[_points(b.column(0))[0]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], names=["p"])

    used = vocabulary.select("word").mapInArrow(points, "p int").distinct().collect()  # at most 116 rows
    return Shards(sizes), bytes(sorted(r[0] for r in used))


def filter_chunks(vocabulary: DataFrame, shards: Shards) -> DataFrame:
    """(chunk, bits): the filters' blocks in chunks of ``2**CHUNK``, 8 bytes a block."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, mask = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.uint64)
            for n, at, points in _by_length(batch.column(0)):
                h = _mixed((_SALT[points] * _powers(n)).sum(axis=1, dtype=np.uint64))
                block[at] = _block(h, *shards.of(n))
                for k in range(PROBES):
                    mask[at] |= np.uint64(1) << _bit(h, k)
            yield pa.RecordBatch.from_arrays([pa.array(block >> CHUNK), pa.array(block), pa.array(mask.view(np.int64))], names=["chunk", "block", "mask"])

    def build(table: pa.Table) -> pa.Table:
        block, mask = table["block"].to_numpy(), table["mask"].to_numpy().view(np.uint64)
        out = np.zeros(1 << CHUNK, np.uint64)
        np.bitwise_or.at(out, block & ((1 << CHUNK) - 1), mask)
        return pa.table({"chunk": pa.array([block[0] >> CHUNK], pa.int64()), "bits": pa.array([out.tobytes()], pa.binary())})

    # a chunk's words are bounded by its blocks: hashing deals KEYS_PER_BLOCK to a block on average
    masks = vocabulary.select("word").mapInArrow(bits, "chunk bigint, block bigint, mask bigint")
    return masks.groupBy("chunk").applyInArrow(build, "chunk bigint, bits binary")


# ---- edits


def _passed(h: np.ndarray, shard: tuple[int, int], low: int, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter's piece lets pass; blocks outside the piece never pass."""
    h = _mixed(h)
    block = _block(h, *shard) - low
    whole = shard[0] >= low and shard[0] + shard[1] <= low + len(bits)
    at = None if whole else np.flatnonzero((block >= 0) & (block < len(bits)))
    if at is not None:
        h, block = h[at], block[at]
    word = bits[block]
    good = np.flatnonzero(word >> _bit(h, 0) & np.uint64(1))
    for k in range(1, PROBES):
        good = good[np.flatnonzero(word[good] >> _bit(h[good], k) & np.uint64(1))]
    return good if at is None else at[good]


def _spelled(rows: np.ndarray) -> pa.Array:
    return _joined(rows.reshape(-1), np.arange(len(rows)) * rows.shape[1], np.full(len(rows), rows.shape[1], np.int64))


def _deletions(points: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of every word without one code point; of equal neighbours only the first is taken out."""
    first = np.ones(points.shape, bool)
    first[:, 1:] = points[:, 1:] != points[:, :-1]
    upto = np.cumsum(h, axis=1, dtype=np.uint64)
    gone = (upto - h) + (upto[:, -1:] - upto) * _BACK
    row, place = np.nonzero(first)
    return row, place, gone[row, place]


def _replacements(points: np.ndarray, h: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cell (row * length + place), new code point's rank and hash of every word with one code point replaced by a greater one."""
    rank = np.searchsorted(alphabet, points.reshape(-1))
    rest = (h.sum(axis=1, dtype=np.uint64)[:, None] - h).reshape(-1)
    power = np.tile(_powers(points.shape[1]), len(points))
    step = max(1, CELLS // len(alphabet))
    for a in range(0, len(rank), step):  # a word of any length is taken in slices
        r = rank[a : a + step]
        more = len(alphabet) - 1 - r
        upto = np.cumsum(more)
        if upto[-1]:
            new = np.arange(upto[-1]) + np.repeat(r + 1 - (upto - more), more)
            cell = np.repeat(np.arange(a, a + len(r)), more)
            yield cell, new, rest[cell] + _SALT[alphabet][new] * power[cell]


def probed_edits(vocabulary: DataFrame, shards: Shards, alphabet: bytes, low: int, bits) -> DataFrame:
    """(edit, word, n): edits of the words that pass the piece of the filter that begins at block ``low``."""
    letters = np.frombuffer(alphabet, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = np.frombuffer(bits.value, np.uint64)
        for batch in batches:
            for n, at, points in _by_length(batch.column(0)):
                h = _SALT[points] * _powers(n)
                found = []
                shorter = shards.of(n - 1)
                if shorter:
                    row, place, gone = _deletions(points, h)
                    good = _passed(gone, shorter, low, piece)
                    row, place = row[good], place[good]
                    kept = np.arange(n - 1)
                    found.append((row, points[row[:, None], kept + (kept >= place[:, None])]))
                for cell, new, replaced in _replacements(points, h, letters):
                    good = _passed(replaced, shards.of(n), low, piece)
                    row, place = np.divmod(cell[good], n)
                    spelled = points[row]
                    spelled[np.arange(len(row)), place] = letters[new[good]]
                    found.append((row, spelled))
                for row, spelled in found:
                    if len(row):
                        words = batch.take(pa.array(at[row]))
                        yield pa.RecordBatch.from_arrays([_spelled(spelled), words.column(0), words.column(1)], names=["edit", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "edit binary, word binary, n bigint")


def near_pairs(vocabulary: DataFrame, piece_blocks: int = PIECE_BLOCKS) -> DataFrame:
    """(word, n, near, near_n): each pair of words that differ by one edit, once."""
    spark = vocabulary.sparkSession
    shards, alphabet = shards_of(vocabulary)
    chunks = materialize(filter_chunks(vocabulary, shards), "variant-filter")
    pairs = None
    step = max(1, piece_blocks >> CHUNK)
    for first in range(0, max(1, math.ceil(shards.total / (1 << CHUNK))), step):  # one pass unless the filters are over 32 MB
        piece = np.zeros((step << CHUNK) if shards.total > step << CHUNK else max(1, shards.total), np.uint64)
        for r in chunks.filter(F.col("chunk").between(first, first + step - 1)).collect():
            a = (r["chunk"] - first) << CHUNK
            part = np.frombuffer(r["bits"], np.uint64)[: len(piece) - a]
            piece[a : a + len(part)] = part
        sent = spark.sparkContext.broadcast(piece.tobytes())
        edits = probed_edits(vocabulary, shards, alphabet, first << CHUNK, sent)
        exact = edits.join(vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("near_n")), "edit")
        some = exact.select("word", "n", F.col("edit").alias("near"), "near_n")
        pairs = some if pairs is None else pairs.unionAll(some)
    return pairs


# ---- forms and roots


def roots(links: DataFrame, most: int) -> DataFrame:
    """(word, root): where following ``form`` ends. Pointer doubling over chains whose counts grow by ``RATIO`` a step, up to ``most``."""
    steps = max(1, math.floor(math.log(max(most, 1) / LEAST, RATIO) + 1e-9) + 1)
    at = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        at = materialize(at.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "variant-roots")
    return at


def variants(docs: DataFrame, slip_mod: int = SLIP_MOD) -> DataFrame:
    """word, n, form, form_n, root, n_near of every word of the documents."""
    counted = word_counts(docs, slip_mod).filter(F.col("n") >= LEAST)
    vocabulary = materialize(counted, "variant-words")
    pairs = near_pairs(vocabulary)
    sides = F.array(
        F.struct(F.col("word"), F.col("n"), F.col("near"), F.col("near_n")),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    best = F.min(F.struct(-F.col("near_n"), F.col("near")))
    near = pairs.select(F.explode(sides).alias("s")).select("s.*").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.col1") >= RATIO * F.col("n")
    judged = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.col1")).alias("form_n"),
    )
    judged = materialize(judged, "variant-forms")
    most = judged.agg(F.max("n")).first()[0] or 1
    root = roots(judged.filter(F.col("form").isNotNull()), most)
    spelled = {c: F.decode(c, "ISO-8859-1") for c in ("word", "form", "root")}
    done = judged.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return done.withColumns(spelled).select("word", "n", "form", "form_n", "root", "n_near")
