"""Language-model scoring by subword lattice likelihood.

A text is its lower-cased words, then one end. Each word (with the mark that
begins it) has many segmentations into pieces of an existing vocabulary; the
model weighs all of them: a forward recursion in log space over the word's
lattice gives its marginal probability, and a text's probability is the product
over its words and the end. Bytes that no piece covers have their own edges,
so every text has a probability.

Piece weights start from the vocabulary's scores (which fall with the piece's
rank, so weight 1 / (rank + 1)) and are re-estimated on the training documents:
``ROUNDS`` expectation steps over the lattices of all their distinct words,
weighted by count, with the start as a prior worth ``PRIOR`` pieces.

Work is per distinct word of the corpus, not per token: words are counted over
all documents, each distinct word gets its count and its marginal once, and
documents join that table. The ``HEAD`` most frequent words are sent to the
tasks (a fixed number, whatever the corpus); the words behind them meet the
table in a join, after each document has summed its repeats.

Defined results: a null or empty text is the end alone; a null doc_id counts as
training text and is not held out; repeated rows are scored alike and each
counts; without training documents the weights stay as they start; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import held_out, raw_texts
from stationflow.session import materialize

VOCABULARY = "piece_bpe_32k.model"
PRIOR = 1_000.0
ROUNDS = 2
HEAD = 200_000
FLUSH = 500_000  # distinct words a task counts before it passes them on
TOGETHER = 200_000  # words whose lattices are walked together
LONG = 64  # words of more bytes are walked one by one
END = b" "  # no word holds a space
BASE = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 21


class Lattice:
    """Pieces with log weights; word lattices of many words at once."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.pieces, self.logp = pieces, logp
        self.longest = max(map(len, pieces))
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.maybe = np.zeros(1 << TABLE_BITS, bool)
        self.maybe[keys >> np.uint64(64 - TABLE_BITS)] = True
        self.ids = {p: i for i, p in enumerate(pieces)}

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _edges(self, codes: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end place: (piece length, words, piece numbers) of the edges that end there."""
        n, size = codes.shape
        upto = np.zeros((n, size + 1), np.uint64)
        for j in range(size):
            upto[:, j + 1] = upto[:, j] * BASE + codes[:, j]
        ends: list[list] = [[] for _ in range(size + 1)]
        for k in range(1, min(self.longest, size) + 1):
            h = upto[:, k:] - upto[:, :-k] * np.uint64(pow(int(BASE), k, 1 << 64))
            at, word = np.nonzero(self.maybe[h >> np.uint64(64 - TABLE_BITS)].T)
            key = h[word, at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            real = self.keys[place] == key
            at, word, piece = at[real], word[real], self.order[place[real]]
            cuts = np.searchsorted(at, np.arange(size - k + 2))
            for i in range(size - k + 1):
                a, b = cuts[i], cuts[i + 1]
                if a < b:
                    ends[i + k].append((k, word[a:b], piece[a:b]))
        return ends

    def _walk(self, words: list[bytes], counts: np.ndarray | None, expected: np.ndarray | None) -> np.ndarray:
        """Log marginals of words of one length; adds expected piece counts."""
        codes = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.uint64) + np.uint64(1)
        size = codes.shape[1]
        ends = self._edges(codes)
        forth = np.full((len(words), size + 1), -np.inf)
        forth[:, 0] = 0
        for j in range(1, size + 1):
            for k, word, piece in ends[j]:
                forth[word, j] = np.logaddexp(forth[word, j], forth[word, j - k] + self.logp[piece])
        if expected is not None:
            back = np.full((len(words), size + 1), -np.inf)
            back[:, size] = 0
            for j in range(size, 0, -1):
                for k, word, piece in ends[j]:
                    on = self.logp[piece] + back[word, j]
                    share = np.exp(forth[word, j - k] + on - forth[word, size]) * counts[word]
                    expected += np.bincount(piece, share, len(self.pieces))
                    back[word, j - k] = np.logaddexp(back[word, j - k], on)
        return forth[:, size]

    def _walk_long(self, word: bytes, count: float, expected: np.ndarray | None) -> float:
        """The same for one long word; sums stay in a window of the longest piece."""
        size, find, logp = len(word), self.ids.get, self.logp
        forth, edges = [0.0] + [-math.inf] * size, []
        for j in range(1, size + 1):
            got = [(k, p) for k in range(1, min(self.longest, j) + 1) if (p := find(word[j - k : j])) is not None]
            values = [forth[j - k] + logp[p] for k, p in got]
            top = max(values)
            forth[j] = top + math.log(sum(math.exp(v - top) for v in values))
            if expected is not None:
                edges.append(got)
        if expected is not None:
            back = [-math.inf] * size + [0.0]
            for j in range(size, 0, -1):
                for k, p in edges[j - 1]:
                    on = logp[p] + back[j]
                    expected[p] += count * math.exp(forth[j - k] + on - forth[size])
                    back[j - k] = np.logaddexp(back[j - k], on)
        return forth[size]

    def marginals(self, words: list[bytes], counts: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """Log marginal probability of each word; with ``expected``, piece counts weighted by ``counts`` are added to it."""
        marked = [b" " + w for w in words]
        sizes = np.array([len(w) for w in marked])
        out = np.zeros(len(words))
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            if size > LONG:
                for i in at:
                    out[i] = self._walk_long(marked[i], 0.0 if counts is None else counts[i], expected)
            else:
                out[at] = self._walk([marked[i] for i in at], None if counts is None else counts[at], expected)
        return out


def vocabulary(name: str = VOCABULARY) -> tuple[list[bytes], np.ndarray, int]:
    """Pieces as bytes (the word mark is a space), their starting weights, and the number of the end piece.

    Pieces go by falling score; the single bytes of the fallback and the end come last.
    """
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=name if os.path.isabs(name) else public_tokenizers.path(name))
    scored = [
        (model.get_score(i), i, model.id_to_piece(i).replace("▁", " ").encode())
        for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    ranked = list(dict.fromkeys(p for _, _, p in sorted(scored, key=lambda x: (-x[0], x[1]))))
    known = set(ranked)
    ranked += [bytes([b]) for b in range(256) if bytes([b]) not in known]
    weight = 1 / np.arange(1, len(ranked) + 2)
    return [*ranked, b"\x00\x00END"], weight / weight.sum(), len(ranked)


# ------------------------------------------------------------------ the corpus's words
def word_counts(docs: DataFrame) -> DataFrame:
    """(w, c) of every distinct word: its count in training texts (0 if it is in others alone), and the end's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["w", "c"])
            seen.clear()
            return out

        for b in batches:
            for held, text in zip(b.column(0).to_pylist(), raw_texts(b.column(1)), strict=True):
                words = text.lower().split()
                if held:
                    for w in words:
                        seen[w] += 0
                    seen[END] += 0
                else:
                    seen.update(words)
                    seen[END] += 1
                if len(seen) > FLUSH:
                    yield flush()
        yield flush()

    rows = docs.select(held_out("doc_id", 7, 2).alias("held"), "text").mapInArrow(run, "w binary, c bigint")
    return rows.groupBy("w").agg(F.sum("c").alias("c"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    words: list[bytes] = []
    counts: list[int] = []
    for b in batches:
        words += b.column(0).to_pylist()
        counts += b.column(1).to_pylist()
        if len(words) >= TOGETHER:
            yield words, np.array(counts, np.int64)
            words, counts = [], []
    if words:
        yield words, np.array(counts, np.int64)


def _expected(trained: DataFrame, lattice: Lattice) -> np.ndarray:
    """Expected uses of each piece over all training words, under the lattice's weights."""
    sent = trained.sparkSession.sparkContext.broadcast(lattice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expected = np.zeros(len(sent.value.pieces))
        for group, counts in _groups(batches):
            sent.value.marginals(group, counts.astype(float), expected)
        got = np.flatnonzero(expected)
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(expected[got])], names=["piece", "n"])

    used = trained.select("w", "c").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    out = np.zeros(len(lattice.pieces))
    for r in used.collect():  # a row for each piece of the vocabulary at most
        out[r.piece] = r.n
    return out


def fit(words: DataFrame, name: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[Lattice, float]:
    """Lattice with re-estimated weights and the log weight of the end, from the rows of :func:`word_counts`."""
    pieces, start, end = vocabulary(name)
    is_end = F.col("w") == F.lit(bytearray(END))
    trained = words.filter((F.col("c") > 0) & ~is_end)
    ends = words.filter(is_end).first()
    weight = start
    for _ in range(rounds):
        n = PRIOR * start + _expected(trained, Lattice(pieces, np.log(weight)))
        n[end] += ends.c if ends else 0
        weight = n / n.sum()
    return Lattice(pieces, np.log(weight)), float(np.log(weight[end]))


def with_marginals(words: DataFrame, lattice: Lattice, end: float) -> DataFrame:
    """(w, c, lp): the rows with each word's log10 marginal."""
    sent = words.sparkSession.sparkContext.broadcast(lattice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, counts in _groups(batches):
            lp = sent.value.marginals(group)
            lp[[w == END for w in group]] = end
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.binary()), pa.array(counts), pa.array(lp / math.log(10))], names=["w", "c", "lp"])

    return words.select("w", "c").mapInArrow(run, "w binary, c bigint, lp double")


def _most_frequent(words: DataFrame, head: int) -> list:
    """At most ``head`` rows: all words of the highest counts that fit.

    The least count that fits comes from the number of words of each count (a
    table of at most sqrt(2 * tokens) rows), so no task sends a share of its own.
    """
    upto = Window.orderBy(F.desc("c"))
    fits = words.groupBy("c").count().withColumn("upto", F.sum("count").over(upto)).filter(F.col("upto") <= head)
    least = fits.agg(F.min("c")).first()[0]
    return [] if least is None else words.filter(F.col("c") >= least).collect()


def score_documents(docs: DataFrame, name: str = VOCABULARY, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counts = materialize(word_counts(docs), "word-counts")
    words = materialize(with_marginals(counts, *fit(counts, name)), "word-marginals")
    tokens, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    top = _most_frequent(words, head)
    sent = docs.sparkSession.sparkContext.broadcast({bytes(r.w): (r.c > 0, math.log10(r.c + 1), r.lp) for r in top})
    tail = words.select(F.col("w").alias("word"), "c", "lp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        names = ["rid", "key", "n", "doc_id", "tokens", "known", "base", "score"]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        for batch in batches:
            for a in range(0, len(batch), 1000):
                b = batch.slice(a, 1000)
                rows: list[tuple] = []
                for rid, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw_texts(b.column(2)), strict=True):
                    own = Counter(text.lower().split())
                    own[END] = 1
                    known, base, score = 0, 0.0, 0.0
                    for w, n in own.items():
                        found = get(w)
                        if found is None:
                            rows.append((rid, w, n, None, None, None, None, None))
                        else:
                            known += n * found[0]
                            base += n * found[1]
                            score += n * found[2]
                    # the document's own row: its key is no word, and another one for each document
                    rows.append((rid, b" %d" % rid, 0, doc_id, own.total(), known, base, score))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    parts = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(
        run, "rid bigint, key binary, n bigint, doc_id bigint, tokens bigint, known bigint, base double, score double"
    )
    joined = parts.join(tail, F.col("key") == F.col("word"), "left")
    n, c = F.col("n"), F.coalesce("c", F.lit(0))
    rows = joined.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.sum("tokens").alias("n_tokens"),
        (F.sum("known") + F.sum(F.when(c > 0, n).otherwise(0))).alias("n_known"),
        (F.sum("base") + F.sum(n * F.log10(c + 1))).alias("base"), (F.sum("score") + F.sum(n * F.coalesce("lp", F.lit(0.0)))).alias("score"),
    )
    total = F.lit(tokens).cast("bigint")
    return rows.select(
        "doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", total.alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(tokens + distinct + 1)).alias("base_score"), "score",
    )
