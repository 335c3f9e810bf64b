"""Null keys, quantiles of counted values, outages over borders, approximate twins, source views, audit stamps."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from stationflow.operators import congestion as cg
from stationflow.operators import meters, profile, staging
from stationflow.operators import utilization as ut
from stationflow.operators.common import exact_quantiles, join_same
from stationflow.sources import bindings as B


def test_quantiles_of_a_null_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 10.0), (None, 20.0), (None, None)], "k string, v double")
    got = {r.k: (r.n, r.max_value, r.q0) for r in exact_quantiles(df, ["k"], "v", [0.5]).collect()}
    assert got == {"a": (2, 3.0, 2.0), None: (2, 20.0, 15.0)}


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_lower_quantiles_are_elements(spark, n):
    rnd = random.Random(n)
    values = [rnd.randrange(300) for _ in range(n)]
    qs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    want = df.agg(*[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY v)").cast("bigint").alias(f"q{i}") for i, q in enumerate(qs)]).first()
    got = exact_quantiles(df, [], "v", qs, disc=True).select(*[f"q{i}" for i in range(len(qs))]).first()
    assert got == want and all(v in values for v in got)


def test_income_profile_of_no_values(spark):
    df = spark.createDataFrame([(None,)], "median_household_income bigint")
    (r,) = profile.income_profile(df).collect()
    assert all(v is None for v in r)


def test_lag_of_a_null_key(spark):
    """A meter with a null key part has its previous reading over a day border, as the plain lag gives it."""
    rows = [("a", None, dt.datetime(2024, 1, d, h), float(10 * d + h)) for d in (1, 2, 4) for h in (3, 9)]
    df = spark.createDataFrame(rows, "u string, s string, at timestamp_ntz, v double")
    got = [r.prev_v for r in meters.lag_chunked(df, ["u", "s"], "at", ["v"]).orderBy("at").collect()]
    assert got == [None, 13.0, 19.0, 23.0, 29.0, 43.0]


def test_join_same_keeps_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    got = join_same(a, b, ["k"], "left").select("k", "a", "b").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 1, 10), ("x", 2, 20), ("y", 3, None)], key=repr)


# ------------------------------------------------------------------ outages
def plain_outages(rows):
    hours = {}
    for s, day, h, r in rows:
        if r == 0:
            hours.setdefault(s, set()).add((day - dt.date(1970, 1, 1)).days * 24 + h)
    out = []
    for s, some in hours.items():
        for a in sorted(some):
            if a - 1 not in some:
                b = a
                while b + 1 in some:
                    b += 1
                out.append((s, a, b))
    return sorted(out, key=repr)


def outages(df):
    epoch = dt.date(1970, 1, 1)
    got = ut.outage_episodes(df).collect()
    assert all(r.outage_hours == (r.end_date - r.start_date).days * 24 + r.end_hour - r.start_hour + 1 for r in got)
    return sorted(((r.station_complex_id, (r.start_date - epoch).days * 24 + r.start_hour, (r.end_date - epoch).days * 24 + r.end_hour) for r in got), key=repr)


def test_outages_over_days_and_months(spark):
    rnd = random.Random(8)
    start, rows = dt.date(2023, 12, 20), []
    for s in ("closed", "never", "mixed", "gaps", None):
        for d in range(100):
            if s == "gaps" and d % 11 == 3:
                continue  # an unreported day breaks a run
            for h in range(24):
                shut = s == "closed" and (d, h) != (50, 13) or s in ("mixed", "gaps", None) and rnd.random() < (0.98 if d % 9 < 5 else 0.3)
                rows.append((s, start + dt.timedelta(days=d), h, 0.0 if shut else 1.0))
    df = spark.createDataFrame(rows, "station_complex_id string, transit_date date, transit_hour bigint, hourly_ridership double").repartition(5)
    got = outages(df)
    assert got == plain_outages(rows)
    closed = [(b - a + 1) for s, a, b in got if s == "closed"]
    assert sorted(closed) == [50 * 24 + 13 - 0, 49 * 24 + 10][::-1]  # over four months, broken by one hour
    assert not any(s == "never" for s, _, _ in got)
    assert ut.outage_episodes(df.limit(0)).count() == 0


def test_no_window_over_a_stations_hours(spark):
    """The widest windows are over (station, month) runs and over a station's runs at month borders."""
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 0, 0.0)], "station_complex_id string, transit_date date, transit_hour bigint, hourly_ridership double")
    plan = ut.outage_episodes(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in line or "+- Window" in line]
    assert windows and all("transit_hour" not in w for w in windows)


# ------------------------------------------------------------------ approximate twins, views, audit
def test_approximate_mode_and_median_are_near(spark):
    rnd = random.Random(2)
    rows = [(k, v) for k in ("a", "b") for v in [7] * 4000 + [rnd.randrange(1000) for _ in range(4000)]]
    df = spark.createDataFrame(rows, "k string, v bigint")
    exact = {r.k: r.top for r in cg.top_value_per_group(df, ["k"], "v", "top").collect()}
    near = {r.k: r.top for r in cg.top_value_per_group(df, ["k"], "v", "top", approx=True).collect()}
    assert exact == near == {"a": 7, "b": 7}


def test_source_views(spark):
    views = B.register_sources(spark, SF_SMALL)
    assert set(views) == {"region", "nation", "customer", "lineitem", "events"}
    assert spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0] == views["nation"].count()


def test_audit_stamp(spark):
    df = staging.with_audit(spark.createDataFrame([(1,), (2,)], "x int"), "at")
    rows = df.collect()
    assert df.columns == ["x", "at"] and len({r["at"] for r in rows}) == 1
    assert abs((dt.datetime.now() - rows[0]["at"]).total_seconds()) < 24 * 3600 + 60


# ------------------------------------------------------------------ layout, bitmaps, thresholds
def test_zorder_skips_files_by_every_column(spark, tmp_path):
    import pyarrow.parquet as pq

    from stationflow.sources import bronze

    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), F.concat(F.lit("s"), F.lpad((F.col("id") * 104729 % 500).cast("string"), 3, "0")).alias("b"),
                                    ((F.col("id") * 15485863) % 997 / 10).alias("c"))
    path = str(tmp_path / "z")
    bronze.write_zorder(df, path, ["a", "b", "c"], files=64)
    assert sorted(spark.read.parquet(path).collect()) == sorted(df.collect())
    files = list((tmp_path / "z").glob("*.parquet"))
    assert len(files) > 40
    met = {"a": 0, "b": 0, "c": 0}
    for f in files:
        stats = pq.read_metadata(f).row_group(0)
        for i, (c, v) in enumerate((("a", 500), ("b", "s250"), ("c", 50.0))):
            s = stats.column(i).statistics
            met[c] += s.min <= v <= s.max
    assert all(n <= len(files) * 0.45 for n in met.values()), met


def test_zorder_of_nulls_and_empty_tables(spark, tmp_path):
    from stationflow.sources import bronze

    df = spark.createDataFrame([(None, None), (1, "x"), (2, None)], "a int, b string")
    for some in (df, df.limit(0)):
        bronze.write_zorder(some, str(tmp_path / "n"), ["a", "b"])
        assert sorted(spark.read.schema(df.schema).parquet(str(tmp_path / "n")).collect(), key=repr) == sorted(some.collect(), key=repr)


def test_bitmaps_beyond_one_bucket(spark):
    """More stations than one bitmap holds, numbered without a gap in meaning; null stations count nowhere."""
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("station_complex_id"), F.lit(dt.date(2024, 1, 31)).alias("transit_date"), (F.col("id") % 2).alias("transit_hour"))
    more = spark.createDataFrame([("5", dt.date(2024, 2, 1), 0), (None, dt.date(2024, 2, 1), 0)], "station_complex_id string, transit_date date, transit_hour bigint")
    hub = rows.unionAll(more)
    numbers = cg.station_numbers(hub)
    assert numbers.select("number").distinct().count() == numbers.count() == 40_000
    bitmaps = cg.station_bitmaps(hub, numbers)
    assert bitmaps.select("bucket").distinct().count() > 1
    got = {(r.grain, r.period_start, r.transit_hour): r.active_stations for r in cg.active_stations_rollup(bitmaps).collect()}
    assert got[("day", dt.date(2024, 1, 31), None)] == 40_000 and got[("all", None, None)] == 40_000
    assert got[("hour", dt.date(2024, 1, 31), 1)] == 20_000 and got[("month", dt.date(2024, 2, 1), None)] == 1


def test_hour_of_week_thresholds(spark):
    rows = [("a", 2, 8, float(v)) for v in (10, 12, 11, 13, 100)] + [("a", 3, 8, 5.0), (None, 2, 8, 1.0), (None, 2, 8, 3.0)]
    df = spark.createDataFrame(rows, "station_complex_id string, day_of_week bigint, transit_hour bigint, hourly_ridership double")
    got = {(r.station_complex_id, r.day_of_week): (r.n, r.median_ridership, r.median_deviation, r.threshold) for r in cg.station_hour_thresholds(df).collect()}
    assert got == {("a", 2): (5, 12.0, 1.0, 16.4478), ("a", 3): (1, 5.0, 0.0, 5.0), (None, 2): (2, 2.0, 1.0, 6.4478)}
