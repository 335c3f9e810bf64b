"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints come from the whole text: each 3-word shingle (XXH64, seed 42)
votes for the 64 bits. Equal fingerprints collapse first, so a group of copies
is one index entry.

The index sorts fingerprints by their rank in the reflected Gray code, where
neighbours share most bits. Its upper nodes are the first ``p`` bits of that
rank: a masked bit pattern of the fingerprint (mask: the top ``p`` bits) that
all members of the node share. A fingerprint visits only the nodes whose
pattern differs from its own in at most ``max_bits`` bits, and carries the
differences so far; nodes that are still large are split again by their next
bits with the budget that is left. Inside a node (one task group) the members,
in Gray order, get further levels of 16 children each: the bits that all
members of a child share are factored into its (mask, pattern), and a whole
child is pruned as soon as the accumulated differences pass ``max_bits``. Pairs
that survive every level are exact.

Inside a node linked members are merged at once, so a dense group emits a star
and not all of its pairs; components of the stars are the components of all
links.

Defined results: a null or empty text (no words) has fingerprint zero and links
like any other; repeated rows each get a row; a null doc_id gets a fingerprint,
and its component is the smallest non-null doc_id reachable (null if none); an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import numbered, raw_texts, text_hash, thrifty
from stationflow.llm.components import connected_components
from stationflow.session import materialize

SHINGLE, MAX_BITS, SEED = 3, 2, 42
NODE = 2048  # members an upper node is planned for
NODE_MOST = 16_384  # a node with more members is split by its next bits
VISITS_MOST = 1 << 18  # and so is one with more members and visitors together
MORE_BITS = 4
FAN = 16  # children of an index node inside a task
BLOCK = 1 << 18  # shingles hashed at a time
TOGETHER = 1000  # documents whose words are held at a time

# XXH64: fixed values of the algorithm
P1, P2, P3 = np.uint64(11400714785074694791), np.uint64(14029467366897019727), np.uint64(1609587929392839161)
P4, P5 = np.uint64(9650029242287828579), np.uint64(2870177450012600261)


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(data: bytes, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many slices of ``data`` (which ends in at least 8 spare bytes)."""
    order = np.argsort(-size, kind="stable")
    at, left = start[order].astype(np.int64), size[order].astype(np.int64)
    long = int(np.searchsorted(-left, -31, side="left"))  # slices of 32 bytes and more come first
    out = np.empty(len(at), np.uint64)
    out[:long] = [xxhash.xxh64_intdigest(data[a : a + n], seed) for a, n in zip(at[:long].tolist(), left[:long].tolist(), strict=True)]
    at, left = at[long:], left[long:].copy()
    wide = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # the 8 bytes from any place
    h = np.uint64(seed) + P5 + left.astype(np.uint64)
    while True:
        n = int(np.searchsorted(-left, -7, side="left"))  # sorted: those with 8 bytes left come first
        if not n:
            break
        k = _rot(wide[at[:n]] * P2, 31) * P1
        h[:n] = _rot(h[:n] ^ k, 27) * P1 + P4
        at[:n] += 8
        left[:n] -= 8
        turn = np.argsort(-left, kind="stable")
        at, left, h, order[long:] = at[turn], left[turn], h[turn], order[long:][turn]
    four = np.flatnonzero(left >= 4)
    k = (wide[at[four]] & np.uint64(0xFFFFFFFF)) * P1
    h[four] = _rot(h[four] ^ k, 23) * P2 + P3
    at[four] += 4
    left[four] -= 4
    for i in range(3):
        one = np.flatnonzero(left > i)
        h[one] = _rot(h[one] ^ ((wide[at[one] + i] & np.uint64(0xFF)) * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    out[long:] = h ^ (h >> np.uint64(32))
    back = np.empty_like(out)
    back[order] = out
    return back


# bit b of a byte, as a count in byte lane b of a 64-bit word
LANES = np.array([sum(((v >> b) & 1) << (8 * b) for b in range(8)) for v in range(256)], np.uint64)


def _votes(hashes: np.ndarray, owner: np.ndarray, votes: np.ndarray) -> None:
    """Add the set bits of each hash to its owner's row of ``votes`` (owners ascend)."""
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    sizes = np.diff(first, append=len(owner))
    runs = -(-sizes // 255)  # a byte lane holds 255 votes
    run_of = np.repeat(np.arange(len(first)), runs)
    starts = first[run_of] + 255 * (np.arange(len(run_of)) - np.repeat(np.cumsum(runs) - runs, runs))
    lanes = LANES[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, starts, axis=0).view(np.uint8).reshape(-1, 64)
    np.add.at(votes, owner[starts], sums)


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each UTF-8 text."""
    words = [t.lower().split() for t in texts]  # bytes.lower() lowers A-Z alone
    counts = np.array([len(w) for w in words], np.int64)
    data = b" ".join(b" ".join(w) for w in words if w) + b" " * 9
    begin = np.concatenate(([0], np.flatnonzero(np.frombuffer(data, np.uint8)[:-9] == 32) + 1, [len(data) - 8]))
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(texts)), counts)
    word = np.arange(len(doc))
    last = word + shingle - 1
    end = (first + counts - 1)[doc]
    here = (last <= end) | (word == first[doc])  # a text of fewer words is one shingle
    doc, word, last = doc[here], word[here], np.minimum(last, end)[here]
    votes = np.zeros((len(texts), 64), np.int32)
    for a in range(0, len(word), BLOCK):
        part = slice(a, a + BLOCK)
        start = begin[word[part]]
        _votes(xxh64(data, start, begin[last[part] + 1] - 1 - start), doc[part], votes)
    cast = np.bincount(doc, minlength=len(texts))
    bits = votes * 2 > cast[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_hash, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), TOGETHER):
                b = batch.slice(a, TOGETHER)
                fp = fingerprints(raw_texts(b.column(2)), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fp)], names=["doc_id", "row_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("row_hash"), "text")
    return rows.mapInArrow(thrifty(run), "doc_id bigint, row_hash bigint, fp bigint")


# ------------------------------------------------------------------ the index
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of 64-bit patterns in the reflected Gray code."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _node(at: Column, p: int) -> Column:
    """The node of ``p`` bits: the first bits of a fingerprint and those of its Gray rank name the same nodes."""
    return F.shiftrightunsigned(at, 64 - p) if p else F.lit(0).cast("bigint")


def _descend(rows: DataFrame, p: int, more: int, max_bits: int) -> DataFrame:
    """Rows (fp, at, d) at nodes of ``p`` bits go on to their nodes of ``p + more`` bits.

    ``at`` is the fingerprint with the bits turned that differ from the
    visited node's pattern, ``d`` how many. A member (d = 0) visits nodes of a
    higher pattern only, so each pair of nodes meets once.
    """
    flips = [(sum(1 << (63 - p - b) for b in c), len(c)) for n in range(max_bits + 1) for c in combinations(range(more), n)]
    turns = F.array(*[F.struct(F.lit(_signed(m)).cast("bigint").alias("mask"), F.lit(n).alias("n")) for m, n in flips])
    out = rows.select("fp", "at", "d", F.explode(turns).alias("t")).filter(F.col("d") + F.col("t.n") <= max_bits)
    out = out.select("fp", F.col("at").bitwiseXOR(F.col("t.mask")).alias("to"), "d", F.col("t.n").alias("n"))
    upward = (F.col("d") > 0) | (F.col("n") == 0) | (_node(F.col("to"), p + more) > _node(F.col("fp"), p + more))
    return out.filter(upward).select("fp", F.col("to").alias("at"), (F.col("d") + F.col("n")).cast("int").alias("d"))


class GrayIndex:
    """Levels over fingerprints in Gray order; a child's shared bits are its (mask, pattern)."""

    def __init__(self, members: np.ndarray):
        self.members = members[np.argsort(gray_rank(members), kind="stable")]
        lows = highs = self.members
        self.levels = []  # from the leaves up: mask, pattern of each node
        while len(lows) > FAN or not self.levels:
            cut = np.arange(0, len(lows), FAN)
            lows, highs = np.bitwise_and.reduceat(lows, cut), np.bitwise_or.reduceat(highs, cut)
            self.levels.append((~(lows ^ highs), lows))
        self.levels.reverse()

    def search(self, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all (query, member) pairs within ``max_bits``."""
        got_q, got_m = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, len(queries), 4096):
            q = queries[a : a + 4096]
            top = len(self.levels[0][0])
            qi, node = np.repeat(np.arange(len(q)), top), np.tile(np.arange(top), len(q))
            spent, known = np.zeros(len(qi), np.uint8), np.zeros(len(qi), np.uint64)
            for depth, (mask, pattern) in enumerate(self.levels):
                spent = spent + np.bitwise_count((q[qi] ^ pattern[node]) & mask[node] & ~known)  # only bits not yet counted
                live = spent <= max_bits
                qi, node, spent = qi[live], node[live], spent[live]
                known = mask[node]
                size = len(self.levels[depth + 1][0]) if depth + 1 < len(self.levels) else len(self.members)
                child = (node[:, None] * FAN + np.arange(FAN)).ravel()
                inside = child < size
                qi, spent, known = (np.repeat(x, FAN)[inside] for x in (qi, spent, known))
                node = child[inside]
            near = spent + np.bitwise_count((q[qi] ^ self.members[node]) & ~known) <= max_bits
            got_q.append(qi[near] + a)
            got_m.append(node[near])
        return np.concatenate(got_q), np.concatenate(got_m)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place reachable over the pairs, for each of n places."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def node_links(members: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a node as stars: members to their local root, visitors to the roots they reach."""
    index = GrayIndex(members)
    m = index.members
    a, b = index.search(m, max_bits)
    root = _roots(len(m), a, b)
    inner = np.flatnonzero(root != np.arange(len(m)))
    q, hit = index.search(visitors, max_bits)
    outer = np.unique(np.stack([q, root[hit]], axis=1), axis=0)
    return np.concatenate([m[inner], visitors[outer[:, 0]]]), np.concatenate([m[root[inner]], m[outer[:, 1]]])


def node_visits(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(p, node, fp, d): the prints that meet in each node, its members (d = 0) and its visitors.

    A node has at most ``NODE_MOST`` members and ``VISITS_MOST`` rows; at 64 bits
    it is one print, and few prints are within ``max_bits`` of it.
    """
    p = max(0, math.ceil(math.log2(max(1, prints.count()) / NODE)))
    # a print makes many visits, so prints of a few files are dealt to as many tasks as a shuffle has
    spread = prints.repartition("fp").select("fp", F.col("fp").alias("at"), F.lit(0).alias("d"))
    rows, found = _descend(spread, 0, p, max_bits), []
    while p < 64:  # distinct fingerprints: at 64 bits a node has one member
        node = _node(F.col("at"), p)
        sizes = rows.groupBy(node.alias("node")).agg(F.count_if(F.col("d") == 0).alias("members"), F.count(F.lit(1)).alias("rows"))
        large = materialize(sizes.filter((F.col("members") > NODE_MOST) | (F.col("rows") > VISITS_MOST)), "nodes")
        if large.isEmpty():
            break
        rows = rows.withColumn("node", node)
        found.append((rows.join(large, "node", "left_anti").drop("node"), p))
        more = min(MORE_BITS, 64 - p)
        # visits to a node without members meet nothing and end here
        rows = rows.join(large.filter("members > 0"), "node", "left_semi").drop("node")
        rows = materialize(_descend(rows, p, more, max_bits), "visits")
        p += more
    found.append((rows, p))
    parts = [r.select(F.lit(bits).alias("p"), _node(F.col("at"), bits).alias("node"), "fp", "d") for r, bits in found]
    visits = parts[0]
    for x in parts[1:]:
        visits = visits.unionAll(x)
    return visits


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): stars that span the same components as all pairs of distinct ``fp`` within ``max_bits``."""

    def links(group: pa.Table) -> pa.Table:
        fp = np.concatenate([c.to_numpy(zero_copy_only=False) for c in group.column("fp").chunks]).view(np.uint64)
        member = np.concatenate([c.to_numpy(zero_copy_only=False) for c in group.column("d").chunks]) == 0
        a = b = np.zeros(0, np.uint64)
        if member.any():
            a, b = node_links(fp[member], fp[~member], max_bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return node_visits(prints, max_bits).groupBy("p", "node").applyInArrow(links, "a bigint, b bigint")


def grouped(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, row_hash, fp, component, component_id): ``component`` is one print of the group."""
    rows = materialize(with_fingerprint(docs, shingle), "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = connected_components(near_links(prints.select("fp"), max_bits))
    joined = prints.join(found, prints.fp == found.vertex, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = joined.join(least, "component").select(F.col("fp").alias("key"), "component", "component_id")
    return rows.join(by_print, rows.fp == by_print.key).drop("key")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    return grouped(docs, shingle, max_bits).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest (doc_id, text hash), null ids last."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("row_hash").alias("hash"))
    first = grouped(docs, shingle, max_bits).groupBy("component").agg(F.min(row).alias("first")).select("first.*")
    rows, keys = numbered(docs)
    first = first.toDF(*keys[:3])
    return rows.filter(F.col(keys[3]) == 1).join(first, keys[:3], "left_semi").select(*[f"`{c}`" for c in docs.columns])
