"""Streams on the state store: late rows are kept, repeats are found without reading the output, files stay few."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.streaming import incremental as inc
from stationflow.streaming import stateful
from stationflow.streaming.versions import VersionedTable

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.DoubleType())])
HOURLY = T.StructType([T.StructField("station_complex_id", T.StringType()), T.StructField("transit_timestamp", T.TimestampNTZType()), T.StructField("ridership", T.DoubleType())])


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=day, hours=hour, minutes=minute)


class Feed:
    def __init__(self, spark, root, schema):
        self.spark, self.root, self.schema = spark, root, schema

    def land(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def __getattr__(self, name):
        return f"{self.__dict__['root']}/{name}"


def test_dedup_by_state(spark, tmp_path, monkeypatch):
    f = Feed(spark, str(tmp_path), SCHEMA)
    read = []
    try_read = inc._try_read
    monkeypatch.setattr(inc, "_try_read", lambda s, p: read.append(p) or try_read(s, p))

    def run(max_files=None):
        return sorted((tuple(r) for r in stateful.stream_dedup_stateful(spark, f.in_, f.out, f.late, f.ckpt, SCHEMA, ["id"], "ts", 2, max_files).collect()), key=repr)

    f.in_ = f"{f.root}/in"
    f.land([(1, at(0), 1.0), (2, at(1), 2.0), (1, at(0), 1.0), (3, None, 3.0), (None, at(1), 4.0)])
    first = run()
    assert first == sorted([(1, at(0), 1.0), (2, at(1), 2.0), (3, None, 3.0), (None, at(1), 4.0)], key=repr)
    # repeats within the delay go, new keys come, also out of order
    f.land([(2, at(1), 2.0), (3, None, 3.0), (None, at(1), 4.0), (5, at(0, 12), 5.0), (6, at(9), 6.0)])
    second = run()
    assert second == sorted([*first, (5, at(0, 12), 5.0), (6, at(9), 6.0)], key=repr)
    # the watermark is at day 7 now: older rows are late, repeats or not, and none is lost
    f.land([(2, at(1), 2.0), (7, at(6, 23), 7.0), (8, at(7), 8.0), (6, at(9), 6.0)])
    third = run(max_files=1)
    assert third == sorted([*second, (8, at(7), 8.0)], key=repr)
    late = spark.read.parquet(f.late).drop("batch_id").collect()
    assert sorted(map(tuple, late)) == [(2, at(1), 2.0), (7, at(6, 23), 7.0)]
    assert read and not any(p.rstrip("/") == f.out for p in read)  # marks only, never the output


@pytest.fixture
def zone(spark):
    """A session time zone with a change of the clock inside the data."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", old)


def test_hourly_hub_by_state(spark, tmp_path, zone):
    """Equal to the batch hub after each run, in any time zone; files follow the dates, not the runs."""
    f = Feed(spark, str(tmp_path), HOURLY)
    f.in_ = f"{f.root}/in"
    rows, files = [], []
    for run in range(7):
        new = [(s, at(day, h, 9 * run + 5), 1.25 + run) for s in ("a", "b") for day in range(8, 12) for h in (1, 2, 3, 23)]
        rows += new
        f.land(new if run else [*new, ("a", None, 9.0)])
        hub = stateful.stream_hourly_state(spark, f.in_, f.out, f.late, f.ckpt, HOURLY)
        if run in (0, 3, 6):
            want = inc.hourly_sums(spark.createDataFrame(rows, HOURLY))
            columns = ["station_complex_id", "transit_date", "transit_hour", "hourly_ridership", "fare_rows"]
            assert sorted(map(tuple, hub.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
        files.append(sum(1 for p in (tmp_path / "out" / "data").rglob("*.parquet")))
    assert max(files) <= files[1]  # two versions, however many runs
    table = VersionedTable(spark, f.out, "transit_date")
    assert len(table.versions()) == 2 and table.meta()["batch"] >= 6
    # a run with one more date rewrites that date alone
    before = {r.transit_date: r.folder for r in table.manifest().collect()}
    f.land([("a", at(12, 5), 2.0)])
    stateful.stream_hourly_state(spark, f.in_, f.out, f.late, f.ckpt, HOURLY)
    after = {r.transit_date: r.folder for r in table.manifest().collect()}
    assert {d: p for d, p in after.items() if d in before} == before and len(after) == len(before) + 1


def test_a_batch_that_is_run_again_is_left_out(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "p")
    rows = spark.createDataFrame([(1, "a", 2.0)], "id bigint, p string, v double")
    table.upsert(rows, ["id"], meta={"batch": 4})
    assert table.meta() == {"batch": 4}
    table.upsert(rows.withColumn("v", F.col("v") + 1), ["id"], meta={"batch": 5})
    assert table.meta(1) == {"batch": 4} and table.meta()["batch"] == 5
