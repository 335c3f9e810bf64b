"""Quality classifier: a generalised additive model with pairwise interactions.

Per-feature lookup tables are learned by cyclic boosting: rounds visit the
features in turn and add a shallow tree (at most ``LEAVES`` leaves over the
feature's quantile bins) fitted to the current logistic gradients. The pairs
with the largest residual gain then get two-dimensional tables the same way.
Scoring a document is a vectorised sum of bin look-ups; features come from the
whole text alone (never from labels, lang, source or the id).

The model is fitted on a bounded sample: at most ``max_train`` labelled rows
(those with the smallest hash of their id). Features, bins and scores cover
every document.

Defined results: a null or empty text has all-zero features and gets a score
like any other; null ids are scored, but never learned from; labels that are
null are skipped; a document with several labels counts once per label; without
labels every score is 0.5; repeated rows are scored alike; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.common import carried, held_out, raw_texts, text_hash, thrifty

MAX_TRAIN = 20_000  # labelled rows a model is fitted on
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, RIDGE = 150, 60, 0.1, 3, 5.0
THRESHOLD = 0.3

FEATURES = (
    "words", "word_len", "max_word", "distinct_words", "repeated_next", "top_word", "lines", "words_per_line",
    "distinct_lines", "upper", "digit", "symbol", "pipe", "bang", "sentence_end", "comma", "other_punct", "non_ascii",
    "brackets", "slashes", "at_signs", "caps_words", "symbol_words", "end_stop",
)


def _bytes(s: bytes) -> np.ndarray:
    lut = np.zeros(256)
    lut[list(s)] = 1
    return lut


BYTE_CLASSES = np.stack([
    _bytes(bytes(range(65, 91))), _bytes(b"0123456789"), _bytes(b"#*$%&<>~^="), _bytes(b"|"), _bytes(b"!"), _bytes(b".?"),
    _bytes(b","), _bytes(b"'\"-;:_`"), _bytes(bytes(range(0x80, 256))), _bytes(b"()[]{}"), _bytes(b"/\\"), _bytes(b"@+"),
], axis=1)
WORD_TAIL = tuple(bytes([c]) for c in b"#*$%&<>~^=|!@+")


def text_features(text: bytes) -> list[float]:
    """The feature vector of one whole text (order of ``FEATURES``)."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ BYTE_CLASSES / len(text)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = list(map(len, words))
    again = sum(map(bytes.__eq__, words, words[1:]))
    caps = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    odd = sum(c for w, c in counts.items() if w.endswith(WORD_TAIL))
    stops = sum(x.rstrip().endswith((b".", b"?", b"!")) for x in lines)
    return [
        np.log1p(n), sum(lengths) / n, np.log1p(max(lengths)), len(counts) / n, again / n, max(counts.values()) / n,
        np.log1p(len(lines)), n / len(lines), len(set(lines)) / len(lines), *shares.tolist(), caps / n, odd / n, stops / len(lines),
    ]


def feature_matrix(column: pa.Array) -> np.ndarray:
    rows = [text_features(t) for t in raw_texts(column)]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


@dataclass
class Gam:
    """Lookup tables: ``edges[f]`` cut feature f into bins, ``tables[f]`` add to the logit."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.intercept)
        for f, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            logit += t[np.searchsorted(e, x[:, f], side="left")]
        for (a, b), t in self.pairs.items():
            logit += t[np.searchsorted(self.pair_edges[a], x[:, a]), np.searchsorted(self.pair_edges[b], x[:, b])]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    cuts = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))
    return cuts[cuts < x.max()] if len(x) else cuts


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A regression tree over ordered bins: the best cuts by Newton gain, one value for each leaf."""
    spans, cg, ch = [(0, len(g))], np.concatenate(([0.0], np.cumsum(g))), np.concatenate(([0.0], np.cumsum(h)))
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for a, b in spans:
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gain = _gain(cg[k] - cg[a], ch[k] - ch[a]) + _gain(cg[b] - cg[k], ch[b] - ch[k]) - _gain(cg[b] - cg[a], ch[b] - ch[a])
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], (a, b), int(k[i]))
        if best[1] is None:
            break
        (a, b), k = best[1], best[2]
        spans.remove((a, b))
        spans += [(a, k), (k, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A cut of the rows of a grid, then one of the columns on each side; returns gain and values."""
    best = (0.0, np.zeros_like(g))
    for k in range(1, g.shape[0]):
        value, gain = np.zeros_like(g), -_gain(g.sum(), h.sum())
        for part in (slice(0, k), slice(k, None)):
            gs, hs = g[part].sum(0), h[part].sum(0)
            t = _tree(gs, hs, 2)
            value[part] = t
            for v in np.unique(t):
                gain += _gain(gs[t == v].sum(), hs[t == v].sum())
        if gain > best[0]:
            best = (gain, value)
    return best


def train(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting of single-feature tables, then of the most useful pairs."""
    if not len(y):
        return Gam()
    rate = (y.sum() + 1) / (len(y) + 2)
    edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    model = Gam(float(np.log(rate / (1 - rate))), edges, [np.zeros(len(e) + 1) for e in edges], coarse)
    bins = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]
    logit = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            if not len(edges[f]):
                continue
            g, h = slopes()
            n = len(edges[f]) + 1
            step = RATE * _tree(np.bincount(b, g, n), np.bincount(b, h, n), LEAVES)
            model.tables[f] += step
            logit += step[b]
    cells = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(coarse)]

    def grid(a, b):
        g, h = slopes()
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        at = cells[a] * shape[1] + cells[b]
        size = shape[0] * shape[1]
        return _pair_tree(np.bincount(at, g, size).reshape(shape), np.bincount(at, h, size).reshape(shape))

    useful = [f for f in range(x.shape[1]) if len(coarse[f])]
    ranked = sorted(((grid(a, b)[0], a, b) for i, a in enumerate(useful) for b in useful[i + 1 :]), reverse=True)
    chosen = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    model.pairs = {p: np.zeros((len(coarse[p[0]]) + 1, len(coarse[p[1]]) + 1)) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            step = RATE * grid(a, b)[1]
            model.pairs[a, b] += step
            logit += step[cells[a], cells[b]]
    return model


def _map_texts(docs: DataFrame, fn, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return docs.mapInArrow(thrifty(run), schema)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", mod: int = 5, rest: int = 0, max_train: int = MAX_TRAIN) -> Gam:
    """Fit on at most ``max_train`` labelled rows whose crc32 remainder is not ``rest``.

    The sample's ids (``max_train`` rows at most) are broadcast to pick its
    texts; the bound holds again for the rows found, so that many rows of one id
    do not pass it. Only feature vectors reach the driver.
    """
    sample = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(target).cast("int").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id", mod, rest))
        .orderBy(F.xxhash64("id"), "id", "y").limit(max_train)
    )
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), text_hash().alias("h"), "text").join(F.broadcast(sample), "id")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    out = pa.schema([("id", pa.int64()), ("y", pa.int32()), ("h", pa.int64()), ("x", pa.list_(pa.float64()))])

    def features(batch):
        x = feature_matrix(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), batch.column("h"), pa.array(list(x), pa.list_(pa.float64()))], schema=out)

    found = _map_texts(rows.select("id", "y", "h", "text"), features, schema)
    got = found.orderBy(F.xxhash64("id"), "id", "y", "h").limit(max_train).toPandas()
    got = got.sort_values(["id", "y", "h"], kind="stable")
    x = np.array(got["x"].tolist(), np.float64).reshape(len(got), len(FEATURES))
    return train(x, got["y"].to_numpy(np.float64))


def with_score(docs: DataFrame, model: Gam, keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` columns of the documents plus the model's score of the whole text, in one pass."""
    kept, text = carried(docs, keep)
    fields = list(kept.schema)[: len(keep)]

    def score(batch):
        s = model.score(feature_matrix(batch.column(text)))
        names = [f"k{i}" for i in range(len(keep))]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(s, pa.float64())], names=[*names, "s"])

    scored = _map_texts(kept, score, T.StructType([*fields, T.StructField("s", T.DoubleType())]))
    return scored.toDF(*keep, name)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels)
    scored = with_score(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), model, ["doc_id"])
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
