"""Dated crosswalk chains, and summaries that merge: against plain walks and the exact operators."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stationflow.operators import crosswalk as cw
from stationflow.operators import summaries as sm
from stationflow.operators.common import exact_quantiles

LINK = "old_id string, new_id string, share double, valid_from date, valid_to date"
D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)


def walk(links, root, day):
    """{newest: share}, or None where the chain meets a cycle."""
    ends, todo = defaultdict(Decimal), [(root, Decimal(1), [root])]
    while todo:
        at, share, path = todo.pop()
        on = [(n, Decimal(str(s))) for o, n, s, a, b in links if o == at and (a is None or a <= day) and (b is None or day < b)]
        if not on:
            ends[at] += share
        for new, s in on:
            if new == at:
                ends[at] += share * s
            elif new in path:
                return None
            else:
                todo.append((new, share * s, [*path, new]))
    return dict(ends)


def resolved(spark, links):
    return cw.crosswalk_periods(spark.createDataFrame(links, LINK))


def on_day(rows, root, day):
    """As :func:`walk`, from resolved periods."""
    on = [r for r in rows if r.old_id == root and r.valid_from <= day < r.valid_to]
    if any(r.on_cycle for r in on):
        assert len(on) == 1 and on[0].new_id == root and on[0].share == 1
        return None
    return {r.new_id: r.share for r in on} or {root: Decimal(1)}


@pytest.mark.parametrize("seed", range(4))
def test_chains_equal_a_plain_walk(spark, seed):
    rnd = random.Random(seed)
    links = []
    for k in range(7):
        for _ in range(rnd.randrange(3)):
            a, n = rnd.randrange(20), rnd.randrange(1, 15)
            news = rnd.sample(range(8), 2) if rnd.random() < 0.4 else [rnd.randrange(k + 1, 8) if rnd.random() < 0.7 else rnd.randrange(8)]
            links += [(f"s{k}", f"s{x}", 1.0 / len(news), None if a < 3 else D(a), None if a + n > 28 else D(a + n)) for x in news]
    rows = resolved(spark, links).collect()
    for k in range(8):
        for day in map(D, range(-1, 36)):
            assert on_day(rows, f"s{k}", day) == walk(links, f"s{k}", day), (k, day)


def test_long_chain_cycle_and_nulls(spark):
    links = [(f"a{i}", f"a{i + 1}", None, None, None) for i in range(40)]
    links += [("x", "y", 1.0, D(0), D(10)), ("y", "z", 1.0, D(0), None), ("z", "y", 1.0, D(5), D(8)), (None, "q", 1.0, None, None), ("e", "f", 1.0, D(9), D(3))]
    periods = resolved(spark, links)
    rows = {(r.old_id, r.valid_from, r.valid_to): (r.new_id, r.share, r.on_cycle) for r in periods.collect()}
    first, last = dt.date(1, 1, 1), dt.date(9999, 12, 31)
    assert all(rows[f"a{i}", first, last] == ("a40", 1, False) for i in range(40))
    assert {k: v for k, v in rows.items() if k[0] in "xyzef"} == {
        ("x", D(0), D(5)): ("z", 1, False), ("x", D(5), D(8)): ("x", 1, True), ("x", D(8), D(10)): ("z", 1, False),
        ("y", D(0), D(5)): ("z", 1, False), ("y", D(5), D(8)): ("y", 1, True), ("y", D(8), last): ("z", 1, False),
        ("z", D(5), D(8)): ("z", 1, True),
    }
    faults = cw.crosswalk_faults(periods).collect()
    assert sorted(tuple(r) for r in faults) == [(s, D(5), D(8), "cycle", 1.0) for s in "xyz"]


def test_shares_that_do_not_add_up_are_reported(spark):
    links = [("a", "b", 0.5, D(0), D(9)), ("a", "c", 0.5, D(0), D(4)), ("p", "a", 1.0, D(2), D(6))]
    got = sorted(tuple(r) for r in cw.crosswalk_faults(resolved(spark, links)).collect())
    assert got == [("a", D(4), D(9), "share", 0.5), ("p", D(4), D(6), "share", 0.5)]


def test_empty_crosswalk(spark):
    assert resolved(spark, []).count() == 0
    days = spark.createDataFrame([("a", D(0), Decimal("1.00"))], "s string, d date, amount decimal(18,2)")
    assert [tuple(r) for r in cw.rekey_days(days, resolved(spark, []), "s", "d", "amount").collect()] == [("a", "a", D(0), Decimal("1.00"))]
    assert cw.rekey_days(days.limit(0), resolved(spark, []), "s", "d", "amount").count() == 0


def test_parts_add_up_to_the_cent(spark):
    """Thirds of thirds over a border of buckets: each day's parts add up to the day; ids and days may be null."""
    third = [("a", x, s, None, None) for x, s in (("b", 0.333333), ("c", 0.333333), ("d", 0.333334))]
    links = third + [("b", x, s, D(300), None) for x, s in (("e", 0.333333), ("f", 0.666667))]
    days = [(s, D(i), Decimal(f"{i % 7}.{i % 100:02d}")) for s in ("a", "b", "zz") for i in range(0, 1500, 7)] + [(None, D(1), Decimal("5.00")), ("a", None, Decimal("7.00"))]
    df = spark.createDataFrame(days, "s string, d date, amount decimal(18,2)")
    got = cw.rekey_days(df, resolved(spark, links), "s", "d", "amount").collect()
    sums, ends = defaultdict(Decimal), defaultdict(set)
    for r in got:
        sums[r.old_id, r.d] += r.amount
        ends[r.old_id, r.d].add(r.s)
    assert dict(sums) == {(s, d): x for s, d, x in days}
    assert ends["a", D(294)] == {"b", "c", "d"} and ends["a", D(301)] == {"c", "d", "e", "f"} and ends["zz", D(7)] == {"zz"} and ends["a", None] == {"a"}


# ------------------------------------------------------------------ summaries
def skewed(spark, n=20_000):
    rnd = random.Random(5)
    value = lambda: float(rnd.choice([7, 7, 7, rnd.randrange(50), round(rnd.expovariate(0.001), 2)]))
    rows = [(rnd.choice(["hot", "hot", "b", None]), rnd.randrange(40), value() if i % 50 else None) for i in range(n)]
    return spark.createDataFrame(rows, "k string, day int, v double").cache()


@pytest.mark.parametrize("size", [1, 10, 100])
def test_quantile_points_keep_their_rank_error(spark, size):
    df = skewed(spark)
    points, steps = sm.quantile_points(df, ["k", "day"], "v", size), 1
    for keys in (["k"], []):
        points = sm.merge_points(points, keys, size)
        steps += 1
        per = points.groupBy(*keys).count().collect()
        assert all(r["count"] <= 2 * size for r in per)
        qs = (0.01, 0.25, 0.5, 0.9, 1.0)
        for r in sm.read_quantiles(points, keys, qs, [f"q{i}" for i in range(5)]).collect():
            values = sorted(x.v for x in (df.filter(F.col("k").eqNullSafe(r.k)) if keys else df).filter("v is not null").collect())
            assert r.n == len(values)
            for i, q in enumerate(qs):
                below, to = sum(x < r[f"q{i}"] for x in values), sum(x <= r[f"q{i}"] for x in values)
                assert to >= q * len(values) and below <= (q + steps / size) * len(values)


def test_points_of_few_values_are_exact(spark):
    df = spark.createDataFrame([("a", i, float(x)) for i in range(5) for x in (1, 2, 3, 4)], "k string, day int, v double")
    points = sm.merge_points(sm.quantile_points(df, ["k", "day"], "v"), ["k"])
    (got,) = sm.read_quantiles(points, ["k"], (0.25, 1.0), ("lo", "hi")).collect()
    want = exact_quantiles(df, ["k"], "v", (0.25, 1.0), disc=True).first()
    assert (got.n, got.lo, got.hi) == (want.n, want.q0, want.q1)
    assert sm.read_quantiles(points.limit(0), ["k"], (0.5,), ("m",)).count() == 0


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_frequent_values_state_their_bounds(spark, size):
    df = skewed(spark).withColumn("week", F.expr("day div 7"))
    day = sm.value_counts(df, ["k", "week", "day"], "v", size)
    week = sm.merge_counts(day, ["k", "week", "day"], ["k", "week"], size)
    total = sm.merge_counts(week, ["k", "week"], ["k"], size)
    true = {(r.k, r.v): r["count"] for r in df.groupBy("k", "v").count().collect()}
    rows = total.collect()
    assert all(r.n <= true[r.k, r.value] <= r.n + r.miss for r in rows)
    listed = {(r.k, r.value) for r in rows}
    cut = {r.k: r.cut for r in rows}
    assert all(n <= cut[k] for (k, v), n in true.items() if v is not None and (k, v) not in listed)
    exact = {r.k: r.v for r in df.groupBy("k").agg(F.mode("v", True).alias("v")).collect()}
    top = sm.read_top_value(total, ["k"]).collect()
    assert {r.k for r in top} == set(exact)
    assert all(r.top_value == exact[r.k] for r in top if r.sure)
    if size == 1000:
        assert all(r.sure and r.n_least == r.n_most == true[r.k, r.top_value] for r in top)
