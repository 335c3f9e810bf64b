"""Alignment of two tokenizers' ids over the same texts, and corpus-wide counts of linked ids.

Each text, with a space before it, is encoded by a byte-level tokenizer (A) and
by a SentencePiece model (B). Both token lists are laid over the text's bytes.

Groups. For each tokenizer an end-to-index dictionary maps the byte offset
behind a token to the token's place. Offsets are small dense integers, so the
dictionary is a table addressed by the offset itself. The intersection of both
key sets, in order, slices both id lists into groups; a group's A and B tokens
cover the same bytes, and no finer cut does. The links of a slice are all its
A-B pairs of token occurrences.

Counts. A document's links are kept as its distinct id pairs and how often each
occurs, so a group of many tokens is not expanded (``BIG``). The number of
documents that hold a pair is summed per batch before the shuffle. The counts
come back to the documents in two ways that give the same rows: the most
frequent pairs (at most ``HEAD``, by a cut on the counts) are sent to the tasks
as a table; a pair below the cut is in few documents, so these rows are
shuffled by pair without a hot key. The highest count of each A id is a table
of at most the vocabulary's size.

Memory: a task holds the tokens of 1 MB of text (or of one longer text) and two
chunk tables; the driver holds the head's table and a histogram of the counts.

Defined results: a null or empty text, and one whose joined tokens are not its
own bytes (U+2581 in a text becomes a space in B), has no tokens, zero figures
and an empty digest; texts of any length are encoded whole; equal rows and rows
that share a doc_id, or have none, are documents of their own; ties for an A
id's highest count all count; an empty table gives an empty result; columns
other than ``text`` and the kept ones are not read, and kept names never clash
with the columns made here, which are renamed (``_pairs``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm import chunks
from stationflow.llm.common import carried, fresh, thrifty
from stationflow.session import materialize, scratch_path

A_NAME, B_NAME = "byte_bpe_50k.json", "piece_bpe_32k.model"
ID_BITS = 22  # of an id in a pair's number
BIG = 4096  # links of a group from which its distinct ids are paired instead of its tokens
HEAD = 400_000
TEXT_BYTES = 1 << 20  # text that a task aligns at a time, in whole texts
LOW = (1 << ID_BITS) - 1


@cache
def byte_level_bytes(name: str) -> list[bytes]:
    """What each id of a byte-level tokenizer stands for."""
    library = chunks.byte_level(name)
    back = {chr(chunks.BYTE_ALPHABET.get(b, b)): b for b in range(256)}
    special = {i for i, t in library.get_added_tokens_decoder().items() if t.special}
    vocabulary = {i: t for t, i in library.get_vocab().items()}
    return [vocabulary[i].encode() if i in special else bytes(back[c] for c in vocabulary.get(i, "")) for i in range(max(vocabulary) + 1)]


class Groups:
    """Groups of the documents that have tokens, in a row: ids, places and the document of each."""

    def __init__(self, a_ids, b_ids, a_off, b_off, a_size, b_size, length):
        self.a_ids, self.b_ids, self.a_off, self.b_off = a_ids, b_ids, a_off, b_off
        a_at, b_at = np.zeros(length + 1, np.int32), np.zeros(length + 1, np.int32)
        a_at[np.cumsum(a_size[a_ids])] = np.arange(1, len(a_ids) + 1, dtype=np.int32)
        b_at[np.cumsum(b_size[b_ids])] = np.arange(1, len(b_ids) + 1, dtype=np.int32)
        common = np.flatnonzero((a_at > 0) & (b_at > 0))
        # group g holds the A tokens a_from[g] to a_to[g] and the B tokens b_from[g] to b_to[g]
        self.a_to, self.b_to = a_at[common].astype(np.int64), b_at[common].astype(np.int64)
        self.a_from = np.concatenate(([0], self.a_to[:-1])) if len(common) else self.a_to
        self.b_from = np.concatenate(([0], self.b_to[:-1])) if len(common) else self.b_to
        self.n_a, self.n_b = self.a_to - self.a_from, self.b_to - self.b_from
        self.doc = np.searchsorted(a_off, self.a_from, "right") - 1
        self.off = np.searchsorted(self.a_from, a_off)  # a document's first group

    def shown(self, joiner: chunks.Joiner, a_vocabulary: int) -> list[memoryview]:
        """Each document's groups as ``a1,a2|b1;...`` (the joiner has an id's digits with a comma, and with the mark that ends its side)."""
        a_last, b_last = np.zeros(len(self.a_ids), np.int64), np.zeros(len(self.b_ids), np.int64)
        a_last[self.a_to - 1] = 1
        b_last[self.b_to - 1] = 1
        codes = np.empty(len(a_last) + len(b_last), np.int32)
        codes[np.arange(len(a_last)) + np.repeat(self.b_from, self.n_a)] = 2 * self.a_ids + a_last
        codes[np.arange(len(b_last)) + np.repeat(self.a_to, self.n_b)] = 2 * (a_vocabulary + self.b_ids) + b_last
        text = memoryview(np.ascontiguousarray(joiner.join(codes)))
        at = joiner.places(codes)[self.a_off + self.b_off].tolist()
        return [text[x : y - 1] for x, y in zip(at[:-1], at[1:], strict=True)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, times, offsets): each document's distinct linked id pairs in order, and the number of links of each."""
        links = self.n_a * self.n_b
        small = np.flatnonzero(links < BIG)
        many = links[small]
        upto = np.cumsum(many)
        g = np.repeat(small, many)
        j = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - many, many)
        i, k = np.divmod(j, self.n_b[g])
        made = [self._number(self.doc[g], self.a_ids[self.a_from[g] + i], self.b_ids[self.b_from[g] + k])]
        times = [np.ones(len(g), np.int64)]
        for x in np.flatnonzero(links >= BIG).tolist():
            a, na = np.unique(self.a_ids[self.a_from[x] : self.a_to[x]], return_counts=True)
            b, nb = np.unique(self.b_ids[self.b_from[x] : self.b_to[x]], return_counts=True)
            made.append(self._number(self.doc[x], a[:, None], b[None, :]).ravel())
            times.append((na[:, None] * nb[None, :]).ravel())
        number = np.concatenate(made)
        if len(made) == 1:
            number, total = np.unique(number, return_counts=True)
        else:
            number, place = np.unique(number, return_inverse=True)
            total = np.zeros(len(number), np.int64)
            np.add.at(total, place, np.concatenate(times))
        off = np.searchsorted(number >> (2 * ID_BITS), np.arange(len(self.a_off)))
        return number & ((1 << 2 * ID_BITS) - 1), total, off

    @staticmethod
    def _number(doc, a, b):
        return (np.asarray(doc, np.int64) << (2 * ID_BITS)) | (a.astype(np.int64) << ID_BITS) | b


class Aligner:
    """Both tokenizers of a task with their chunk tables."""

    def __init__(self, a_name: str, b_name: str):
        a, b = chunks.byte_level(a_name), chunks.piece_model(b_name)
        self.a_table, self.b_table = chunks.byte_level_table(a), chunks.piece_table(b)
        self.a_bytes, self.b_bytes = chunks.Joiner(byte_level_bytes(a_name)), chunks.Joiner(chunks.piece_bytes(b))
        self.a_vocabulary = len(self.a_bytes.size)

    def digits(self) -> chunks.Joiner:
        n_a, n_b = self.a_vocabulary, len(self.b_bytes.size)
        return chunks.Joiner([b"%d%c" % (i, c) for i in range(n_a) for c in b",|"] + [b"%d%c" % (i, c) for i in range(n_b) for c in b",;"])

    def groups(self, column: pa.Array) -> tuple[np.ndarray, Groups]:
        """The rows that have tokens, and their groups."""
        buf, off = chunks.spaced(column)
        a_ids, a_off = self._encode(self.a_table, buf, off, chunks.split_starts)
        b_buf, b_at = chunks.spaced(pc.replace_substring(column, "▁", " "))
        b_ids, b_off = self._encode(self.b_table, b_buf, b_at, chunks.marked_starts)
        good = np.diff(off) > 0
        for ids, at, strings in ((a_ids, a_off, self.a_bytes), (b_ids, b_off, self.b_bytes)):
            joined, ends = strings.join(ids), strings.places(ids)[at]
            if len(joined) != len(buf) or not np.array_equal(joined, buf):
                for r in np.flatnonzero(good).tolist():
                    good[r] = np.array_equal(joined[ends[r] : ends[r + 1]], buf[off[r] : off[r + 1]])
        rows = np.flatnonzero(good)
        if len(rows) < len(good):
            a_ids, a_off = self._only(a_ids, a_off, good)
            b_ids, b_off = self._only(b_ids, b_off, good)
        return rows, Groups(a_ids, b_ids, a_off, b_off, self.a_bytes.size, self.b_bytes.size, int(np.diff(off)[rows].sum()))

    @staticmethod
    def _encode(table, buf, off, cut):
        starts = cut(buf, off)
        ids, upto = table.ids(buf, starts)
        return ids, upto[np.searchsorted(starts, off)]

    @staticmethod
    def _only(ids, off, good):
        many = np.diff(off)
        return ids[np.repeat(good, many)], np.concatenate(([0], np.cumsum(many[good])))


def _spread(rows: np.ndarray, n: int, values: np.ndarray) -> pa.Array:
    """The values at their rows, zero in all others."""
    out = np.zeros(n, np.int64)
    out[rows] = values
    return pa.array(out)


def _lists(rows: np.ndarray, n: int, off: np.ndarray, values: np.ndarray, kind) -> pa.ListArray:
    """Lists at their rows, empty in all others."""
    many = np.zeros(n + 1, np.int32)
    many[rows + 1] = np.diff(off)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(many, dtype=np.int32)), pa.array(values, kind))


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def align(docs: DataFrame, keep: list[str], a_name: str = A_NAME, b_name: str = B_NAME) -> DataFrame:
    """The kept columns, the figures of each document and its distinct linked id pairs with their number of links.

    A pair is the number ``a << 22 | b``.
    """
    rows, at = carried(docs, keep)
    names: list[str] = []
    for c in FIGURES:
        names.append(fresh(c, [*keep, *names]))
    made = [T.LongType()] * 4 + [T.StringType(), T.ArrayType(T.LongType(), False), T.ArrayType(T.LongType(), False)]
    kept = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in zip(FIGURES, made, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_name, b_name)
        digits = aligner.digits()
        for batch in batches:
            for x, y in chunks.slices(batch.column(at), TEXT_BYTES):
                part = batch.slice(x, y - x)
                has, g = aligner.groups(part.column(at))
                n = len(part)
                digest = np.full(n, "", object)
                digest[has] = [hashlib.sha256(t).hexdigest() for t in g.shown(digits, aligner.a_vocabulary)]
                pair, times, off = g.pairs()
                links = np.concatenate(([0], np.cumsum(g.n_a * g.n_b)))
                figures = (np.diff(g.a_off), np.diff(g.b_off), np.diff(g.off), np.diff(links[g.off]))
                columns = [_spread(has, n, f) for f in figures] + [pa.array(digest, pa.string())]
                columns += [_lists(has, n, off, pair, pa.int64()), _lists(has, n, off, times, pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], names=schema.names)
        del aligner, digits

    return rows.mapInArrow(thrifty(run), schema).toDF(*keep, *names)


def pair_counts(aligned: DataFrame, pairs: str = "pairs") -> DataFrame:
    """(pair, n, top): how many documents hold each id pair linked, and whether no pair of its A id is in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    partial = aligned.select(F.col(f"`{pairs}`").alias("pairs")).mapInArrow(run, "pair bigint, n bigint")
    counts = materialize(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.shiftright("pair", ID_BITS)
    best = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # at most one row for each id of A
    return counts.join(F.broadcast(best), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("top"))


def _head(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """A cut on n above which at most ``most`` pairs lie, and these pairs in order with n and top."""
    level = F.floor(4 * F.log2("n")).cast("int")
    seen, cut = 0, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 4 * 63 rows
        seen += r["count"]
        if seen > most:
            break
        cut = r["level"]
    if cut is None:
        return 1 << 62, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = counts.filter(level >= cut).toArrow().sort_by("pair")
    return cut, head["pair"].to_numpy(), head["n"].to_numpy(), head["top"].to_numpy().astype(np.int64)


def with_counts(aligned: DataFrame, counts: DataFrame, most: int = HEAD) -> DataFrame:
    """The aligned rows (with ``row``, a number of their own) without their lists, with ``n_best`` and ``count_sum``."""
    spark = aligned.sparkSession
    cut, *table = _head(counts, most)
    sent = spark.sparkContext.broadcast(table)
    others = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    schema = T.StructType([*others, *(T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")), *aligned.schema.fields[-2:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, top = sent.value
        for batch in batches:
            lists, times = batch.column(len(others)), batch.column(len(others) + 1).flatten().to_numpy(zero_copy_only=False)
            pair, off = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            known = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            best, total, rest = (np.zeros(len(pair) + 1, np.int64) for _ in range(3))
            best[1:][known] = (top[at] * times)[known] if len(pairs) else 0
            total[1:][known] = (count[at] * times)[known] if len(pairs) else 0
            rest[1:] = ~known
            sums = [pa.array(np.diff(np.cumsum(x)[off])) for x in (best, total)]
            places = pa.array(np.cumsum(rest)[off].astype(np.int32))
            left = [pa.ListArray.from_arrays(places, pa.array(x[~known], pa.int64())) for x in (pair, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *sums, *left], names=schema.names)

    looked = materialize(aligned.select(*[f.name for f in others], "pairs", "times").mapInArrow(run, schema), "pairs-looked-up")
    # pairs below the cut: none is in many documents, so dealing them by pair makes no hot task
    rare = counts.filter(F.floor(4 * F.log2("n")).cast("int") < F.lit(cut))
    left = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    found = left.join(rare, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    both = looked.drop("pairs", "times").join(found, "row", "left")
    sums = {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
    return both.withColumns(sums).drop("row", "more_best", "more_sum")


def align_documents(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME, most: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of each document."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    aligned = align(ids, ["doc_id"], a_name, b_name)
    path = scratch_path(spark, "aligned")
    # the row numbers hold for good once they are written
    aligned.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    schema = T.StructType([T.StructField("row", T.LongType()), *aligned.schema.fields])
    aligned = spark.read.schema(schema).parquet(path)
    counts = materialize(pair_counts(aligned), "pair-tops")
    return with_counts(aligned, counts, most)
