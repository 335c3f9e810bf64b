"""Versioned tables: atomic versions, concurrent writers, marts from changes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.operators import recovery as rec
from stationflow.streaming import live, versions
from stationflow.streaming.versions import VersionConflict, VersionedTable

SCHEMA = "id bigint, p string, v double"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "p")
    assert t.version() == 0 and t.read() is None and t.meta() == {}
    t.upsert(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (None, "c", 4.0)], SCHEMA), ["id"])
    return t


def test_versions_stay_readable(spark, table):
    """A key that moves leaves its partition, nulls are values of their own, and the older version is as it was."""
    before = rows_of(table.read(), "id", "p", "v")
    assert before == sorted([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (None, "c", 4.0)], key=repr)
    batch = spark.createDataFrame([(1, "b", 10.0), (3, None, 30.0), (None, "c", 40.0), (5, "d", 50.0)], SCHEMA)
    assert table.upsert(batch, ["id"]) == 2
    assert rows_of(table.read(), "id", "p", "v") == sorted([(1, "b", 10.0), (2, "b", 2.0), (3, None, 30.0), (None, "c", 40.0), (5, "d", 50.0)], key=repr)
    assert rows_of(table.read(1), "id", "p", "v") == before
    # "a" lost its last row: it is no live partition any more, and counts as changed
    assert rows_of(table.manifest(), "p", "rows") == sorted([("b", 2), (None, 1), ("c", 1), ("d", 1)], key=repr)
    assert rows_of(table.changed(1), "p") == sorted([("a",), ("b",), (None,), ("c",), ("d",)], key=repr)


def test_order_within_a_batch(spark, table):
    batch = spark.createDataFrame([(1, "a", 5.0, 1), (1, "a", 7.0, 3), (1, "a", 6.0, 2)], SCHEMA + ", seen int")
    table.upsert(batch, ["id"], order=["seen"])
    assert rows_of(table.read().filter("id = 1"), "id", "p", "v") == [(1, "a", 7.0)]


@pytest.mark.parametrize("call", ["before the marker", "in the marker"])
def test_a_writer_that_dies_leaves_the_old_version_whole(spark, table, monkeypatch, call):
    before = rows_of(table.read(), "id", "p", "v")
    batch = spark.createDataFrame([(1, "z", 9.0), (2, "z", 9.0)], SCHEMA)

    def dies(spark, path, text):
        if call == "in the marker":  # a half-written file beside the marker's place
            out = open(f"{path}.0000.tmp", "w")
            out.write(text[:10])
            out.close()
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "_write_once", dies)
        with pytest.raises(RuntimeError, match="lost"):
            table.upsert(batch, ["id"])
    assert table.version() == 1 and rows_of(table.read(), "id", "p", "v") == before
    assert table.upsert(batch, ["id"]) == 2
    assert rows_of(table.read().filter("p = 'z'"), "id") == [(1,), (2,)]


def test_two_writers_on_one_version(spark, table, monkeypatch):
    """The slower writer finds its number taken and starts again from the newer state: neither batch is lost."""
    once, state = versions._write_once, {"other": True}

    def other_first(s, path, text):
        if state.pop("other", False):
            VersionedTable(spark, table.root, "p").upsert(spark.createDataFrame([(2, "b", 22.0), (8, "b", 8.0)], SCHEMA), ["id"])
        return once(s, path, text)

    monkeypatch.setattr(versions, "_write_once", other_first)
    assert table.upsert(spark.createDataFrame([(9, "b", 9.0)], SCHEMA), ["id"]) == 3
    assert rows_of(table.read().filter("p = 'b'"), "id", "v") == [(2, 22.0), (8, 8.0), (9, 9.0)]
    assert table.commit(table.read(1), table.read(1).select("p"), 1) == 0
    monkeypatch.setattr(versions, "_write_once", lambda *a: False)
    with pytest.raises(VersionConflict):
        table.upsert(spark.createDataFrame([(9, "b", 1.0)], SCHEMA), ["id"], attempts=2)


def test_a_reader_keeps_its_version(spark, table):
    held = table.read()
    table.upsert(spark.createDataFrame([(1, "a", 100.0)], SCHEMA), ["id"])
    assert rows_of(held.filter("id = 1"), "v") == [(1.0,)]


def test_vacuum_keeps_what_is_live(spark, table):
    for i in range(3):
        table.upsert(spark.createDataFrame([(1, "a", float(i))], SCHEMA), ["id"])
    before = rows_of(table.read(), "id", "p", "v")
    assert table.vacuum(keep=1) > 0
    assert table.versions() == [4] and rows_of(table.read(), "id", "p", "v") == before
    assert table.upsert(spark.createDataFrame([(7, "a", 7.0)], SCHEMA), ["id"]) == 5


def test_unchanged_partitions_keep_their_files(spark, table):
    files = {f for f in table.read().inputFiles()}
    table.upsert(spark.createDataFrame([(2, "b", 5.0)], SCHEMA), ["id"])
    kept = files & set(table.read().inputFiles())
    assert len(kept) == len(files) - 1
    assert all("data/0000000002-" in f for f in table.read(partitions=table.changed(1)).inputFiles())


# ------------------------------------------------------------------ marts from changes
def facts_rows(spark, rows):
    made = []
    for station, day, fare, riders, name in rows:
        made.append((station, dt.datetime.fromisoformat(f"{day}T08:00:00"), fare, "omny", name, "queens", 40.7, -73.9, dt.date.fromisoformat(day), 8,
                     int(day[:4]), int(day[5:7]), riders, dt.date.fromisoformat(day[:8] + "01")))
    columns = "station_complex_id string, transit_timestamp timestamp_ntz, fare_class string, payment_method string, station_name string, borough string, "
    columns += "latitude double, longitude double, transit_date date, transit_hour bigint, transit_year bigint, transit_month bigint, ridership double, month date"
    return spark.createDataFrame(made, columns)


def rebuilt(facts):
    return rec.recovery_from_monthly(rec.monthly_totals(facts.read().drop("month")))


def test_marts_follow_the_loads(spark, tmp_path):
    """After every load the marts equal the rebuild; a correction reads and writes only what it touches."""
    facts, months, mart = (VersionedTable(spark, str(tmp_path / n), p) for n, p in (("f", "month"), ("m", "bucket"), ("r", "bucket")))
    stations = [str(i) for i in range(12)]
    first = [(s, f"{y}-{m:02d}-05", f, 10.25 * (int(s) + 1) + m, f"st {s}") for s in stations for y in (2019, 2022) for m in (1, 2, 4) for f in ("a", "b")]
    loads = [
        first,
        [("3", "2022-05-05", "a", 7.5, "st 3"), ("50", "2022-05-06", "a", 1.0, "new st")],
        # the name that was the greatest of its month goes away, and a baseline month is corrected
        [("3", "2022-05-05", "a", 9.0, "a 3"), ("4", "2019-02-05", "b", 0.5, "st 4")],
        # the same values again: nothing changes
        [("3", "2022-05-05", "a", 9.0, "a 3")],
    ]
    for i, load in enumerate(loads):
        facts.upsert(facts_rows(spark, load), live.FACT_KEY)
        live.refresh_months(facts, months)
        live.refresh_recovery(months, mart)
        want = rebuilt(facts)
        assert rows_of(mart.read().drop("bucket"), *want.columns) == rows_of(want, *want.columns)
        if i == 2:
            assert rows_of(facts.changed(2, 3), "month") == [(dt.date(2019, 2, 1),), (dt.date(2022, 5, 1),)]
            change = live.month_changes(facts, 2, 3)
            read = {f.split("/data/")[1].split("/part")[0] for f in change.inputFiles()}
            live_folders = {r.folder.removeprefix("data/") for v in (2, 3) for r in facts.manifest(v).filter("month in ('2019-02-01', '2022-05-01')").collect()}
            assert read == live_folders and len(facts.read(3).inputFiles()) > len(read)
            # of the twelve stations the months of two are added to: with their spellings, three lines
            assert rows_of(change, "station_complex_id", "station_name", "_rows") == [("3", "a 3", 1), ("3", "st 3", -1), ("4", "st 4", 0)]
            touched = rows_of(months.changed(2, 3), "bucket")
            assert touched == rows_of(change.select(live.bucket().alias("bucket")).distinct(), "bucket")
        if i == 3:
            assert live.month_changes(facts, 3, 4).count() == 0


def test_a_refresh_that_failed_is_caught_up(spark, tmp_path, monkeypatch):
    facts, months = VersionedTable(spark, str(tmp_path / "f"), "month"), VersionedTable(spark, str(tmp_path / "m"), "bucket")
    facts.upsert(facts_rows(spark, [("1", "2022-01-05", "a", 5.0, "x")]), live.FACT_KEY)
    live.refresh_months(facts, months)
    facts.upsert(facts_rows(spark, [("1", "2022-01-05", "a", 6.0, "x")]), live.FACT_KEY)
    with monkeypatch.context() as m:
        m.setattr(versions, "_write_once", lambda *a: False)
        with pytest.raises(VersionConflict):
            live.refresh_months(facts, months)
    facts.upsert(facts_rows(spark, [("1", "2022-01-06", "a", 1.0, "x")]), live.FACT_KEY)
    live.refresh_months(facts, months)
    live.refresh_months(facts, months)  # nothing to do
    assert months.version() == 2 and months.meta() == {"source": 3}
    assert rows_of(months.read().withColumn("r", F.col("_r").cast("double")), "r", "_rows") == [(7.0, 2)]
