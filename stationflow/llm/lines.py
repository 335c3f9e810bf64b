"""Quality rules by line labelling: a linear-chain conditional random field marks content and boilerplate.

Each line with a word gets a feature vector; the field scores a label for every
line and every step between neighbouring lines, and Viterbi decoding gives the
best labelling of the whole text. A document is kept if its base rules hold and
at least ``CONTENT_SHARE`` of its words stand in content lines.

The field is trained on a bounded sample: lines of at most ``max_train``
labelled documents (those with the smallest hash of their id), in chains of at
most ``CHAIN`` lines; a longer text gives ``CHAINS`` of its chains, picked from
all of it by a hash of id and place. Lines of good documents are content. Of bad documents, the
lines that a first fit without steps between lines tells from those of good
ones are boilerplate. Decoding covers all lines of all documents.

Defined results: a null or empty text has no words, fails the base rules and is
not kept; blank lines have no label; without labels every line is content;
repeated rows are judged alike, null ids like any other; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.common import IS_SPACE, raw_texts, text_hash

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
CONTENT_SHARE = 0.5
MAX_TRAIN, CHAIN, CHAINS = 3_000, 64, 4
STEPS, RATE, RIDGE = 150, 0.1, 1e-3
GROUP_BYTES = 4 << 20

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "bias", "log_words", "word_bytes", "upper", "digits", "symbols", "pipes", "bangs", "symbol_ends", "repeats", "stop_end", "dup", "short", "first",
)


def _class(*parts: bytes) -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[list(b"".join(parts))] = True
    return lut


UPPER, DIGIT, SYMBOL, PIPE, BANG = _class(bytes(range(65, 91))), _class(b"0123456789"), _class(SYMBOLS), _class(b"|"), _class(b"!")
IN_WORD_CHAR = ~IS_SPACE & ~_class(bytes(range(0x80, 0xC0)))  # first bytes of code points in words


def _upto(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(ids: np.ndarray, counts: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """For each text, how many of its words stand in windows that it holds twice or more.

    ``ids``: exact word numbers of all texts in a row, ``counts``: words of each text.
    """
    n, first = len(ids), np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(n) + window <= (first + counts)[doc])
    if not len(at):
        return np.zeros(len(counts), np.int64)
    key = _mix(doc[at].astype(np.uint64))
    for k in range(window):
        key = _mix(key * np.uint64(3) + ids[at + k].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    same = np.flatnonzero(key[order[:-1]] == key[order[1:]])
    a, b = a[same], b[same]
    equal = doc[a] == doc[b]
    for k in range(window):
        equal &= ids[a + k] == ids[b + k]
    begin = np.unique(np.concatenate([a[equal], b[equal]]))
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(counts))


@dataclass
class Lines:
    """Base figures of some texts and the features of their lines with a word."""

    base: np.ndarray  # texts x (words, word characters, symbols, repeated lines, repeated words)
    doc: np.ndarray  # text of each line
    words: np.ndarray  # words of each line
    x: np.ndarray  # lines x FEATURES


def analyse(texts: list[bytes]) -> Lines:
    numbers: dict[bytes, int] = {}
    ids_list: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    dup: list[bool] = []
    for i, t in enumerate(texts):
        words = t.split()
        counts[i] = len(words)
        ids_list += [numbers.setdefault(w, len(numbers)) for w in words]
        seen: set[bytes] = set()
        for line in t.split(b"\n"):
            dup.append(line in seen)
            seen.add(line)
    ids = np.array(ids_list, np.int64)
    data = b"\n".join(texts)
    buf = np.frombuffer(data, np.uint8)
    begin = np.concatenate(([0], np.flatnonzero(buf == 10) + 1)) if texts else np.zeros(0, np.int64)
    end = np.append(begin[1:] - 1, len(buf)) if texts else begin
    lines_of = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lines_of)
    space = IS_SPACE[buf]
    starts, closes = ~space, ~space
    starts[1:] &= space[:-1]
    closes[:-1] &= space[1:]
    word_upto = _upto(starts)
    n_words = word_upto[end] - word_upto[begin]
    size = np.maximum(end - begin, 1)

    def count(mask: np.ndarray) -> np.ndarray:
        upto = _upto(mask)
        return upto[end] - upto[begin]

    symbol = SYMBOL[buf]
    n_symbols, n_chars, solid = count(symbol), count(IN_WORD_CHAR[buf]), count(~space)
    again = np.zeros(len(ids), bool)
    again[1:] = ids[1:] == ids[:-1]
    again[word_upto[begin[word_upto[begin] < len(ids)]]] = False  # not across lines
    again_upto = _upto(again)
    repeats = again_upto[word_upto[end]] - again_upto[word_upto[begin]]
    live = n_words > 0
    dup_line = np.array(dup, bool)
    nw = np.maximum(n_words, 1)
    tail = np.maximum.accumulate(np.where(space, -1, np.arange(len(buf)))) if len(buf) else np.zeros(0, np.int64)
    last = np.zeros(len(begin), np.uint8)
    last[live] = buf[tail[end[live] - 1]]
    ordinal = np.arange(len(begin)) - np.repeat(np.cumsum(lines_of) - lines_of, lines_of)
    x = np.stack([
        np.ones(len(begin)), np.log1p(n_words), solid / nw / 10, count(UPPER[buf]) / size, count(DIGIT[buf]) / size, n_symbols / size * 5,
        count(PIPE[buf]) / size * 5, count(BANG[buf]) / size * 5, count(closes & symbol) / nw, repeats / nw, np.isin(last, list(b".!?")),
        dup_line, n_words < 3, ordinal == 0,
    ], axis=1)[live] if len(begin) else np.zeros((0, len(FEATURES)))

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, len(texts)).astype(np.int64)

    base = np.stack([counts, per_doc(n_chars), per_doc(n_symbols), per_doc(dup_line & live), repeated_words(ids, counts)], axis=1)
    return Lines(base, doc[live], n_words[live], x)


@dataclass
class Crf:
    """Two labels (0 boilerplate, 1 content): a line's score for content, and the score of each step."""

    w: np.ndarray = field(default_factory=lambda: np.eye(1, len(FEATURES))[0])
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Viterbi labels of chains laid end to end (``counts`` lines each); all chains step together."""
        out = np.zeros(len(x), np.int8)
        order = np.argsort(-counts, kind="stable")
        order = order[counts[order] > 0]
        first, size = (np.cumsum(counts) - counts)[order], counts[order]
        score = np.stack([np.zeros(len(x)), x @ self.w], axis=1)
        back = np.zeros((len(x), 2), np.int8)
        best = score[first]
        final = best.copy()
        for t in range(1, int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t, side="left"))  # chains longer than t
            at = first[:n] + t
            paths = best[:n, :, None] + self.steps
            back[at] = paths.argmax(axis=1)
            best = paths.max(axis=1) + score[at]
            final[:n] = best
        label = final.argmax(axis=1).astype(np.int8)
        for t in range(int(size[0]) - 1 if len(size) else -1, -1, -1):
            n = int(np.searchsorted(-size, -t, side="left"))
            at = first[:n] + t
            out[at] = label[:n]
            label[:n] = back[at, label[:n]]
        return out


def _slopes(x, y, real, w, steps):
    """Gradient of the mean log-likelihood of padded chains (forward-backward)."""
    s, length, _ = x.shape
    score = np.stack([np.zeros((s, length)), x @ w], axis=2)
    forth, back = np.zeros((s, length, 2)), np.zeros((s, length, 2))
    forth[:, 0] = score[:, 0]
    for t in range(1, length):
        forth[:, t] = np.where(real[:, t, None], np.logaddexp.reduce(forth[:, t - 1, :, None] + steps, axis=1) + score[:, t], forth[:, t - 1])
    for t in range(length - 2, -1, -1):
        on = np.logaddexp.reduce(steps + (back[:, t + 1] + score[:, t + 1])[:, None, :], axis=2)
        back[:, t] = np.where(real[:, t + 1, None], on, 0)
    total = np.logaddexp.reduce(forth[:, -1], axis=1)
    p = np.exp(forth[..., 1] + back[..., 1] - total[:, None]) * real
    dw = np.einsum("sl,slf->f", (y - p) * real, x)
    pair = np.exp(forth[:, :-1, :, None] + steps + (score + back)[:, 1:, None, :] - total[:, None, None, None])
    both = (real[:, 1:])[..., None, None]
    seen = np.zeros((s, length - 1, 2, 2))
    np.put_along_axis(seen.reshape(s, length - 1, 4), (y[:, :-1] * 2 + y[:, 1:]).astype(int)[..., None], 1, axis=2)
    return dw, ((seen - pair) * both).sum(axis=(0, 1)), real.sum()


def train(x: np.ndarray, y: np.ndarray, real: np.ndarray, linked: bool = True) -> Crf:
    """Adam on the penalised log-likelihood; without ``linked`` the steps stay at zero."""
    theta = np.zeros(x.shape[2] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, STEPS + 1):
        w, steps = theta[:-4], theta[-4:].reshape(2, 2)
        dw, ds, n = _slopes(x, y, real, w, steps)
        g = np.concatenate([dw, ds.ravel() * linked]) / max(n, 1) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Crf(theta[:-4], theta[-4:].reshape(2, 2))


def _chains(x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of documents as padded chains: features, labels, real places, and each line's place."""
    parts = -(-counts // CHAIN)
    chain_doc = np.repeat(np.arange(len(counts)), parts)
    doc = np.repeat(np.arange(len(counts)), counts)
    ordinal = np.arange(len(x)) - np.repeat(np.cumsum(counts) - counts, counts)
    chain = (np.cumsum(parts) - parts)[doc] + ordinal // CHAIN
    place = chain * CHAIN + ordinal % CHAIN
    n = len(chain_doc) * CHAIN
    fx, fy, real = np.zeros((n, x.shape[1])), np.zeros(n), np.zeros(n, bool)
    fx[place], fy[place], real[place] = x, y[doc], True
    return fx.reshape(-1, CHAIN, x.shape[1]), fy.reshape(-1, CHAIN), real.reshape(-1, CHAIN), place


def picked_lines(doc_id: int, n: int) -> np.ndarray:
    """Which of a training document's n lines are used: whole chains, those with the smallest hash of (id, chain), in their order."""
    chain = np.arange(-(-n // CHAIN))
    rank = [zlib.crc32(b"%d:%d" % (doc_id, c)) for c in chain.tolist()]
    use = np.sort(np.argsort(rank, kind="stable")[:CHAINS])
    return np.flatnonzero(np.isin(np.arange(n) // CHAIN, use))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Crf:
    """Train on the lines of at most ``max_train`` labelled documents."""
    sample = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("quality").cast("int").alias("y")).dropna()
        .orderBy(F.xxhash64("id"), "id", "y").limit(max_train)
    )
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), text_hash().alias("h"), "text").join(F.broadcast(sample), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = []
            for i, text in zip(b.column(0).to_pylist(), raw_texts(b.column(3)), strict=True):
                own = analyse([text]).x
                x.append(own[picked_lines(i, len(own))].ravel())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "h", "x"])

    found = rows.select("id", "y", "h", "text").mapInArrow(run, "id bigint, y int, h bigint, x array<double>")
    got = found.orderBy(F.xxhash64("id"), "id", "y", "h").limit(max_train).toPandas().sort_values(["id", "y", "h"], kind="stable")
    if got["y"].nunique() < 2:
        return Crf()
    per = [np.asarray(v, np.float64).reshape(-1, len(FEATURES)) for v in got["x"]]
    counts, x, quality = np.array([len(v) for v in per]), np.concatenate(per), got["y"].to_numpy(np.float64)
    fx, fy, real, place = _chains(x, counts, quality)
    alone = train(fx, fy, real, linked=False)
    line_y = np.where(np.repeat(quality, counts) == 1, 1.0, x @ alone.w > 0)
    fy.reshape(-1)[place] = line_y
    return train(fx, fy, real)


RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("content_words", T.LongType()), T.StructField("content_lines", T.ArrayType(T.ByteType()))]
)


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def label_lines(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, the base figures, words in content lines, and the label of each line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, content, labels = [], [], []
            for group in _groups(raw_texts(b.column(1))):
                got = analyse(group)
                counts = np.bincount(got.doc, minlength=len(group))
                label = model.decode(got.x, counts)
                base.append(got.base)
                content.append(np.bincount(got.doc, got.words * label, len(group)).astype(np.int64))
                labels += np.split(label, np.cumsum(counts)[:-1])
            figures = np.concatenate(base) if base else np.zeros((0, 5), np.int64)
            words = np.concatenate(content) if content else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c) for c in figures.T), pa.array(words), pa.array(labels, pa.list_(pa.int8()))], names=["doc_id", *RESULT.names]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), *RESULT]))


def judge(docs: DataFrame, labels: DataFrame, share: float = CONTENT_SHARE) -> DataFrame:
    """Base figures, base_failed and kept of every document."""
    rows = label_lines(docs, fit(docs, labels))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("content_words") >= share * F.col("n_words"))
    return rows.select("doc_id", *RESULT.names[:5], "base_failed", kept.alias("kept"), "content_words")
