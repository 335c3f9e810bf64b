"""Each corpus operator against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from stationflow.llm import chat, decontam, gam, lattice, lines, mixing, simhash, suffix, tokens, warc  # noqa: E402
from stationflow.llm.common import count_words, ship  # noqa: E402

random.seed(7)
PROSE = " ".join(random.choice("the river keeps running over stones while small birds watch from high banks".split()) for _ in range(80))
# extra columns whose names clash with internal ones
EXTRA = ("score", "fp", "k0", "t", "size", "taken", "first", "n", "id", "hash", "component", "_score", "w", "key", "rid", "ids", "shard")

DOCS = [
    (1, PROSE, "a"), (2, PROSE + " end", "a"), (3, None, "a"), (4, "", "b"), (5, " \n\t ", "b"), (6, "One", "b"), (7, "two words", None),
    (8, "line\nline\n\nline", None), (9, "x " * 60_000, "c"), (9, "x " * 60_000, "c"), (10, "é ß ÀÉ ñ" * 30, "c"), (10, PROSE[:200], "a"),
    (None, PROSE, "a"), (None, None, None), (11, "y" * 5_000, "d"), (12, PROSE.upper(), "d"), (13, "A-b c_D 1.5 e" * 9, "e"), (14, "#*$ %& <|> " * 30, "e"),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in DOCS], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return rows.withColumns({c: F.lit(7) for c in EXTRA}).repartition(4)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (14, 0, 0), (8, None, 0), (None, 1, 0), (1, 1, 0), (13, 0, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").withColumn("score", F.lit(1))


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(df, columns, expected):
    assert got(df, *columns) == sorted(expected, key=repr)


ID_TEXT = [(i, t) for i, t, _ in DOCS]


def test_words_are_counted_across_text_borders():
    import pyarrow as pa

    texts = ["a b", None, " c", "", "d ", "é\nf g", "\t"]
    assert count_words(pa.array(texts)).tolist() == [len(brute.words(t)) for t in texts]
    assert count_words(pa.array(texts).slice(2, 4)).tolist() == [1, 0, 1, 3]
    assert count_words(pa.array([], pa.string())).tolist() == []


# ------------------------------------------------------------------ mixing
def test_mix(docs):
    sizes = [(s, len(brute.words(t))) for _, t, s in DOCS]
    target, total = brute.mix_targets(sizes)
    rows = mixing.mix_documents(docs).collect()
    same(mixing.mix_documents(docs), ("doc_id", "source", "size", "source_size"), [(i, s, len(brute.words(t)), total[s]) for i, t, s in DOCS])
    assert len(rows) == len(DOCS)
    for s in total:
        own = [r for r in rows if r.source == s]
        assert all(math.isclose(r.target, target[s]) and r.source_size == total[s] for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 1
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mixing.mix_documents(docs).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(again, key=key) == sorted(rows, key=key)


def test_mix_every_prefix_is_balanced(spark):
    needs = spark.createDataFrame([(0, 50), (1, 30), (2, 0), (3, 20)], "sid bigint, need bigint")
    slots = sorted(mixing.schedule(needs, 100).collect(), key=lambda r: r.slot)
    assert len(slots) == 100
    count = {0: 0, 1: 0, 3: 0}
    for k, r in enumerate(slots, 1):
        assert r["rank"] == count[r.sid]
        count[r.sid] += 1
        assert all(abs(count[s] - k * w / 100) < 6 for s, w in ((0, 50), (1, 30), (3, 20)))


def test_mix_pieces_tile_the_taken_words(spark, docs):
    from stationflow.session import materialize

    rows, pieces = mixing.mix(materialize(mixing.sized(docs)), block=16)
    taken = sum(r.taken for r in rows.collect())
    cut = pieces.collect()
    assert sum(p.to_word - p.from_word for p in cut) == taken
    assert len({(p.sid, p.block, p.start, p.epoch) for p in cut}) == len(cut) and all(0 <= p.from_word < p.to_word for p in cut)


def test_mixed_documents(docs):
    took = sum(r.taken for r in mixing.mix_documents(docs).collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sum(len(brute.words(r.text)) for r in rows) == took
    assert all(any((r.text or "") == (t or "")[: len(r.text or "")] for _, t, _ in DOCS) and r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("turned", [False, True])
def test_mixed_documents_of_equal_rows_in_two_sources(spark, turned):
    """Equal ids and texts in two sources are taken as each source's target says, whatever the input's order."""
    text = "word " * 100
    rows = [(7, text, "en", s, len(text)) for s in ["a", "b"] * 40] + [(8, text, "en", "b", len(text))] * 20
    df = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)
    target = {r.source: r.target for r in mixing.mix_documents(df).select("source", "target").distinct().collect()}
    took = {"a": 0, "b": 0}
    for r in mixing.mixed_documents(df).collect():
        took[r.source] += len(r.text.split())
    assert all(abs(took[s] - target[s]) <= 1 for s in took)


# ------------------------------------------------------------------ near-duplicates
def test_one_of_each_does_not_follow_the_order_of_rows(spark):
    rows = [(1, PROSE, "en", s, 3) for s in ("b", "a", None, "c")]
    kept = set()
    for some in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(some, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)
        (r,) = simhash.one_of_each(df).collect()
        kept.add(r)
    assert len(kept) == 1


def test_simhash(docs):
    same(simhash.near_duplicates(docs), ("doc_id", "fingerprint", "component_id"), brute.simhash_groups(ID_TEXT))


def test_one_of_each(docs):
    rows = simhash.one_of_each(docs)
    assert rows.columns == docs.columns
    assert sorted((r.doc_id for r in rows.select("doc_id").collect()), key=repr) == brute.simhash_groups(ID_TEXT, representatives=True)


def test_hash_of_slices():
    import xxhash

    data = bytes(random.randrange(256) for _ in range(500)) + b" " * 8
    start = np.array([random.randrange(400) for _ in range(400)])
    size = np.array([random.choice([0, 1, 3, 4, 5, 7, 8, 9, 15, 16, 24, 31, 32, 33, 90]) for _ in range(400)])
    assert [int(h) for h in simhash.xxh64(data, start, size)] == [xxhash.xxh64_intdigest(data[a : a + n], 42) for a, n in zip(start, size)]


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    near = [base ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) for _ in range(4)]
    members = np.unique(np.concatenate([base, *near]))
    index = simhash.GrayIndex(members)
    q, m = index.search(members, 2)
    pairs = np.nonzero(np.bitwise_count(members[:, None] ^ index.members[None, :]) <= 2)
    assert set(zip(q.tolist(), m.tolist())) == set(zip(*(x.tolist() for x in pairs)))


def test_nodes_split_and_keep_all_links(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(2)
    hot = np.uint64(0xABCD) << np.uint64(48)  # most prints share their first bits
    base = hot | rng.integers(0, 1 << 20, 300, dtype=np.uint64)
    prints = np.unique(np.concatenate([base, base ^ np.uint64(1 << 50), rng.integers(0, 1 << 63, 50, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp bigint")
    monkeypatch.setattr(simhash, "NODE", 32)
    monkeypatch.setattr(simhash, "NODE_MOST", 64)
    from stationflow.llm.components import connected_components

    found = {r.vertex: r.component for r in connected_components(simhash.near_links(df)).collect()}
    root = simhash._roots(len(prints), *np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2))
    ours, theirs = {}, {}
    for i, p in enumerate(prints.view(np.int64).tolist()):
        ours.setdefault(found.get(p, p), set()).add(p)
        theirs.setdefault(int(root[i]), set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_visitors_of_a_node_are_bounded(spark, monkeypatch):
    """Most prints share their first 16 bits: those who visit the nodes around are split like members are."""
    monkeypatch.setattr(simhash, "NODE", 8)
    monkeypatch.setattr(simhash, "NODE_MOST", 64)
    monkeypatch.setattr(simhash, "VISITS_MOST", 100)
    rng = np.random.default_rng(4)
    hot = (np.uint64(0xABCD) << np.uint64(48)) | rng.integers(0, 1 << 48, 1500, dtype=np.uint64)
    near = hot[:40] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ np.uint64(1 << 49)
    prints = np.unique(np.concatenate([hot, near, rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp bigint")
    sizes = simhash.node_visits(df).groupBy("p", "node").agg(F.count_if(F.col("d") == 0).alias("m"), F.count(F.lit(1)).alias("n")).collect()
    assert max(r.n for r in sizes) <= 100 and max(r.m for r in sizes) <= 64
    from stationflow.llm.components import connected_components

    found = {r.vertex: r.component for r in connected_components(simhash.near_links(df)).collect()}
    a, b = np.nonzero(np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2, 1))
    signed = prints.view(np.int64).tolist()
    assert len(a) >= 30 and all(found.get(signed[i], signed[i]) == found.get(signed[j], signed[j]) for i, j in zip(a, b))
    assert set(found) <= {signed[i] for i in (*a, *b)}  # and no other print is in a group


def test_components_of_a_chain(spark):
    from stationflow.llm.components import connected_components

    links = [(i, i + 1) for i in range(40)] + [(100, 101), (5, 5), (None, 3)]
    out = {r.vertex: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {k: v for k, v in out.items() if k != v} == {i: 0 for i in range(1, 41)} | {101: 100}


# ------------------------------------------------------------------ substring dedup
@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_suffix_repeats(spark, monkeypatch, hot):
    ship(spark)
    monkeypatch.setattr(suffix, "HOT", hot)
    alphabet = "abcdefgh "
    passages = ["".join(random.choice(alphabet) for _ in range(n)) for n in (99, 100, 101, 150, 400)]
    rows = []
    for i in range(80):
        parts = [random.choice(passages)[random.randrange(20) :] if random.random() < 0.5 else "".join(random.choices(alphabet, k=60)) for _ in range(5)]
        rows.append((i * 7 % 81, "".join(parts)))
    rows += [(200, "a" * 400), (201, "a" * 300), (202, None), (203, ""), (204, "ß" * 200), (-5, passages[4])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in EXTRA}).repartition(5)
    same(suffix.remove_repeats(df), ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.repeats(sorted(rows, key=lambda r: r[0])))


def test_suffix_ties_and_copies(docs):
    from stationflow.llm.common import text_hash

    hashes = {r.text: r.h for r in docs.select("text", text_hash().alias("h")).collect()}

    def order(row):  # rows of one id go by the hash of their text
        return (row[0] is None, row[0] or 0, hashes[row[1]])

    same(suffix.remove_repeats(docs), ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.repeats(sorted(ID_TEXT, key=order)))


def test_family_levels_stay_logarithmic():
    rng = np.random.default_rng(3)
    family, seen = suffix.Family(), set()
    for _ in range(60):
        a, b = rng.integers(0, 4000, 100).astype(np.uint64), np.zeros(100, np.uint64)
        told = family.add(a, b)
        for x, y in zip(a.tolist(), told.tolist()):
            assert y == (x in seen)
            seen.add(x)
    assert len(family.levels) <= 14 and sum(len(x) for x, _ in family.levels) == len(seen)


# ------------------------------------------------------------------ line rules
def test_line_rules(docs, labels):
    rows = lines.judge(docs, labels).collect()
    figures = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    expected = []
    for i, t in ID_TEXT:
        f = brute.line_figures(t)
        expected.append((i, *f, f[0] < 20 or 100 * f[4] > 30 * f[0]))
    assert sorted(figures, key=repr) == sorted(expected, key=repr)
    assert not any(r.kept and r.base_failed for r in rows)


def test_training_rows_are_bounded_when_one_id_has_many(spark, monkeypatch):
    """3,000 rows of one labelled id: the bound holds for what reaches the driver."""
    seen = []
    rows = spark.range(3000).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("row with words "), F.col("id").cast("string")).alias("text"))
    labelled = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    monkeypatch.setattr(gam, "train", lambda x, y: seen.append(len(x)))
    gam.fit(rows, labelled, max_train=2)
    chains = lines._chains
    monkeypatch.setattr(lines, "_chains", lambda x, counts, y: seen.append(len(counts)) or chains(x, counts, y))
    lines.fit(rows.withColumn("doc_id", F.col("doc_id")).unionAll(rows.limit(1).withColumn("doc_id", F.lit(2).cast("bigint"))), labelled, max_train=3)
    assert all(n <= 3 for n in seen) and seen


def test_training_lines_come_from_the_whole_text():
    n = 40 * lines.CHAIN + 5
    picked = [lines.picked_lines(i, n) for i in range(50)]
    assert all(len(p) <= lines.CHAINS * lines.CHAIN and (np.diff(p) > 0).all() for p in picked)
    chains = np.concatenate([np.unique(p // lines.CHAIN) for p in picked])
    assert chains.min() < 5 and chains.max() > 35  # not the first ones alone
    assert lines.picked_lines(1, 10).tolist() == list(range(10)) and not len(lines.picked_lines(1, 0))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    model = lines.Crf(rng.normal(size=len(lines.FEATURES)), rng.normal(size=(2, 2)))
    counts = np.array([3, 0, 1, 6])
    x = rng.normal(size=(10, len(lines.FEATURES)))
    got_labels, at = model.decode(x, counts), 0
    for n in counts:
        u = x[at : at + n] @ model.w
        best = max((sum(u[i] * (k >> i & 1) for i in range(n)) + sum(model.steps[k >> i & 1, k >> i + 1 & 1] for i in range(n - 1)), k) for k in range(1 << n))[1]
        assert got_labels[at : at + n].tolist() == [best >> i & 1 for i in range(n)]
        at += n


def test_crf_gradient():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(2, 4, 3)), rng.integers(0, 2, (2, 4)).astype(float)
    real = np.array([[True] * 4, [True, True, False, False]])
    w, steps = rng.normal(size=3), rng.normal(size=(2, 2))

    def loglik(w, steps):
        total = 0.0
        for c in range(2):
            n = int(real[c].sum())
            u = x[c, :n] @ w
            paths = [sum(u[i] * (k >> i & 1) for i in range(n)) + sum(steps[k >> i & 1, k >> i + 1 & 1] for i in range(n - 1)) for k in range(1 << n)]
            own = sum(int(y[c, i]) << i for i in range(n))
            total += paths[own] - np.logaddexp.reduce(paths)
        return total

    dw, ds, _ = lines._slopes(x, y, real, w, steps)
    for i in range(3):
        e = np.eye(3)[i] * 1e-6
        assert np.isclose(dw[i], (loglik(w + e, steps) - loglik(w - e, steps)) / 2e-6, atol=1e-5)
    for i in range(4):
        e = np.eye(4)[i].reshape(2, 2) * 1e-6
        assert np.isclose(ds.ravel()[i], (loglik(w, steps + e) - loglik(w, steps - e)) / 2e-6, atol=1e-5)


# ------------------------------------------------------------------ chat
def test_chat(spark):
    tricky = ["[TURN]x[/TURN]", "\\", "\\[", "<\\", "[NEXT]", "<|im_start|>", "[", "a[\\]b", "\\\\<[", "[BODY]\n[/INST]</s>", "", None]
    rows = [(c, k, role, t) for c in (1, 2) for k, (role, t) in enumerate(zip(["user", "assistant", "assistant", None, "[BODY]"] * 3, tricky))]
    rows += [(None, 0, "assistant", "q"), (3, 1, "b", "2"), (3, 1, "a", "1"), (3, 1, "a", "1"), (3, None, "assistant", "first")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({c: F.lit(1) for c in ("t", "s", "blocks", "loss")})
    out = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(chat.format_conversations(df)).collect()}
    assert out == brute.chat_digest(rows)
    formatted = chat.format_conversations(df)
    assert all("</s>" not in r.formatted and "<|" not in r.formatted for r in formatted.collect())
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ decontamination
ITEMS = [
    (1, PROSE[40:140]), (2, "two Words"), (3, None), (4, "  ...  "), (5, "One"), (1, PROSE[200:300]), (None, "x x x"), (7, "nothing of this stands in any document at all here"),
]
CONTAMINATION = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block_chars", [10**6, 60])
def test_decontamination(spark, docs, block_chars):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("t", F.lit(1))
    found = decontam.find_contamination(docs, items, ["doc_id"], block_chars=block_chars)
    rows = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()]
    expected = brute.contamination(ID_TEXT, ITEMS)
    assert sorted((i, n, h, len(x)) for i, n, h, x in rows if i is not None) == sorted(r[:4] for r in expected if r[0] is not None)
    if block_chars > 60:
        same(decontam.decontaminate(docs, items), CONTAMINATION, expected)


def test_candidates_of_few_distinct_words(monkeypatch):
    """A text over two words and items over the same: the windows found equal a plain scan, in little memory."""
    import tracemalloc

    rnd = random.Random(3)
    word = lambda n: " ".join(rnd.choice("01") for _ in range(n)).encode()
    items = [(str(i), word(10 if i % 3 else 6)) for i in range(400)]
    texts = [word(30_000), b"", word(9), b"1 0", b"2 " + word(12)]
    tracemalloc.start()
    index = decontam.WindowIndex(items, {b"0": 5, b"1": 4})
    rows = decontam._mark(texts, index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6  # 400 windows at half of 30,000 places, all at once: 1.5 GB
    for text, (n, spans, names) in zip(texts, rows):
        words = text.split()
        want = {(a, a + len(x), i) for i, t in items for x in [t.split()] for a in range(len(words) - len(x) + 1) if words[a : a + len(x)] == x}
        assert n == len(words) and set(spans) == {(a, b) for a, b, _ in want} and names == {i for _, _, i in want}


@pytest.mark.parametrize("most", [1, 40, 1000])
def test_pieces_of_a_long_item_have_its_windows(most):
    words = [b"w%d" % (i % 37) for i in range(300)]
    for n in (0, 3, 9, 10, 11, 300):
        text = b" ".join(words[:n])
        pieces = [decontam.words_of(p) for p in decontam._pieces(text, most, 10)]
        grams = lambda x: {tuple(x[i : i + 10]) for i in range(max(1, len(x) - 9))} if x else set()
        assert set().union(*map(grams, pieces)) == grams(words[:n])


def test_decontamination_without_items(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    same(decontam.decontaminate(docs, none), CONTAMINATION, brute.contamination(ID_TEXT, []))


# ------------------------------------------------------------------ language model
LM = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")


@pytest.mark.parametrize("head", [3, 10_000])
def test_lattice_scores(docs, head):
    rows = lattice.score_documents(docs, head=head)
    expected = brute.lm_base(ID_TEXT)
    found = sorted((tuple(r) for r in rows.select(*LM, "base_score", "score").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    expected.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in found], [r[5] for r in expected])
    assert all(r[6] < 0 for r in found)


def _all_segmentations(model, word):
    if not word:
        return [0.0]
    out = []
    for k in range(1, len(word) + 1):
        p = model.ids.get(word[:k])
        if p is not None:
            out += [model.logp[p] + rest for rest in _all_segmentations(model, word[k:])]
    return out


def test_marginal_weighs_all_segmentations():
    pieces, weight, _ = lattice.vocabulary()
    model = lattice.Lattice(pieces, np.log(weight))
    words = [b"the", b"a", "né".encode(), b"river", b"zq9", b"x" * 80]
    expected_counts = np.zeros(len(pieces))
    found = model.marginals(words, np.arange(1.0, 7), expected_counts)
    for w, m in zip(words[:5], found):
        assert math.isclose(m, np.logaddexp.reduce(_all_segmentations(model, b" " + w)), rel_tol=1e-9)
    long = model.marginals([b"x" * 80])[0]
    assert math.isclose(long, model._walk([b" " + b"x" * 80], None, None)[0], rel_tol=1e-9)
    # every byte is covered by exactly one expected piece
    assert math.isclose(sum(c * len(p) for c, p in zip(expected_counts, pieces)), sum((i + 1) * (len(w) + 1) for i, w in enumerate(words)), rel_tol=1e-9)


# ------------------------------------------------------------------ WARC
WARC = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_warc_round_trip(spark):
    ship(spark)
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (None, "a"), (None, "only"), (5, "é" * 9), (5, "é" * 9), (0, "<html>" * 99), (6, "z" * 300_000)]
    pages = spark.createDataFrame([(i, f"http://x/{i} \r\n", h) for i, h in rows], "page_id bigint, url string, html string").withColumn("sha", F.lit(1))
    same(warc.archive_pages(pages), WARC, brute.warc_rows(rows))
    assert warc.archive_pages(pages.limit(0)).count() == 0


def _archive(n=8):
    import hashlib

    payloads = [bytes([65 + i]) * 400 for i in range(n)]
    return [warc.record(i, None, p, hashlib.sha1(p).digest(), None) for i, p in enumerate(payloads)]


def _check(content, damaged):
    """Records and gaps tile the content; all records but the damaged ones come back."""
    found, at = list(warc.salvage(content)), 0
    for a, b, *_ in found:
        assert a == at and b > a
        at = b
    assert at == len(content)
    ids = [int(h["warc-record-id"].split(":")[-1][:-1]) for _, _, h, _, _ in found if h]
    assert ids == [i for i in range(8) if i not in damaged]
    return [r for *_, r in found if r]


def test_gaps_are_logged(spark, tmp_path):
    """A damaged record is missing among the records and stands in the table of gaps."""
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * 50) for i in range(6)], "page_id bigint, url string, html string").coalesce(1)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    assert warc.recovered(spark, path).count() == 6 and spark.read.parquet(f"{path}-gaps").count() == 0
    (file,) = [p for p in Path(path).iterdir() if p.name.startswith("part-") and p.stat().st_size]
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 0x55
    file.write_bytes(bytes(data))
    for crc in Path(path).glob(".*.crc"):
        crc.unlink()
    assert warc.recovered(spark, path).count() == 5
    gaps = spark.read.parquet(f"{path}-gaps").collect()
    assert len(gaps) >= 1 and all(g.length > 0 and g.archive.endswith(file.name) for g in gaps)


def test_salvage_of_members():
    parts = [warc.members(r) for r in _archive()]
    assert _check(b"".join(parts), ()) == []
    broken = [*parts]
    broken[2] = parts[2][:30] + b"\0\0\0\0" + parts[2][34:]
    broken[5] = parts[5][:-20]
    assert len(_check(b"".join(broken), (2, 5))) == 2
    assert len(_check(b"junk" + b"".join(parts), ())) == 1
    assert len(_check(b"".join(parts)[:-9], (7,))) == 1


def test_salvage_of_version_lines():
    parts = _archive()
    assert _check(b"".join(parts), ()) == []
    broken = [*parts]
    broken[3] = parts[3].replace(b"DDDD", b"DXDD", 1)
    assert _check(b"".join(broken), (3,)) == ["block digest"]


def test_long_record_takes_several_members():
    import hashlib

    payload = bytes(range(256)) * 80_000
    packed = warc.members(warc.record(1, None, payload, hashlib.sha1(payload).digest(), None))
    assert packed[-1] == 0
    ((a, b, head, block, gap),) = warc.salvage(packed)
    assert (a, b, gap) == (0, len(packed), None) and block.endswith(payload)


# ------------------------------------------------------------------ token files
def test_encoder_equals_the_library():
    e = tokens.Encoder()
    odd = ["", "a\tb  c\n\n d", "  lead", "trail  ", "a\x1c b", "don't  we're\n\n\n ok", "<|endoftext|> a", "é\xa0ü ß", " x y", "1 2  3\r\n4", " \n ", PROSE]
    for t in odd:
        assert np.frombuffer(e.encode([t])[0], "<i4").tolist() == e.library.encode(t, add_special_tokens=False).ids


def test_token_files(spark, docs):
    e = tokens.Encoder()
    rows = tokens.encode_documents(docs).collect()

    def summary(text):
        ids = [*e.library.encode(text or "", add_special_tokens=False).ids, 2]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == sorted(((i, *summary(t)) for i, t in ID_TEXT), key=repr)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    by_place = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert by_place == sorted(by_place, key=lambda i: (i is not None, i or 0))


def test_token_metadata_reads_no_ids(spark, docs):
    from stationflow.session import scratch_path

    path = scratch_path(spark, "tokens-test")
    tokens.write_tokens(docs, path)
    plan = tokens.read_tokens(spark, path).select("doc_id", "n_tokens").filter("doc_id = 9")._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "ids" not in schema and "PushedFilters" in plan


# ------------------------------------------------------------------ quality classifier
def test_classifier_edges(docs, labels):
    rows = gam.classify(docs, labels).collect()
    assert len(rows) == len(DOCS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (brute.crc_rest(r.doc_id, 5) == 0) for r in rows)
    none = gam.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_classifier_learns_an_interaction():
    rng = np.random.default_rng(8)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.train(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95


def test_classifier_on_held_out_documents(spark):
    from conftest import SF_ORACLE
    from stationflow.llm.queries import QUERIES

    rows = QUERIES["op10_quality_gam"](spark, SF_ORACLE).join(spark.read.parquet(f"{SF_ORACLE}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


# ------------------------------------------------------------------ empty tables
def test_empty_tables(spark, docs, labels):
    none = docs.limit(0)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for df in (
        mixing.mix_documents(none), mixing.mixed_documents(none), simhash.near_duplicates(none), simhash.one_of_each(none), suffix.remove_repeats(none),
        lines.judge(none, labels), decontam.decontaminate(none, items), lattice.score_documents(none), tokens.encode_documents(none), gam.classify(none, labels),
    ):
        assert df.count() == 0
