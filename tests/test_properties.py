"""Invariants of the operators on the shared test tables (sf0.001) and on synthetic geometry."""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationflow.operators import catchment as ca
from stationflow.operators import meters as mtr
from stationflow.operators import utilization as ut
from stationflow.plans import catalog as C
from stationflow.session import scratch_path
from stationflow.sources import bindings as B
from stationflow.streaming import incremental as inc

D = SF_SMALL


def test_spine_has_24_hours_per_station_day(spark):
    hub = C.hub_fine(spark, D)
    dense = ut.hour_spine(hub)
    per_day = dense.groupBy("station_complex_id", "transit_date").agg(F.count(F.lit(1)).alias("n"), F.sum("is_gap_hour").alias("gaps"))
    assert per_day.filter(F.col("n") != 24).count() == 0
    active = hub.groupBy("station_complex_id", "transit_date").agg(F.count(F.lit(1)).alias("rows"))
    j = per_day.join(active, ["station_complex_id", "transit_date"])
    assert j.filter(F.col("gaps") + F.col("rows") != 24).count() == 0


def test_status_counts_add_up_to_24(spark):
    daily = C.daily_fine(spark, D)
    total = F.col("active_hours") + F.col("disruption_hours") + F.col("anomalous_zero_hours") + F.col("expected_low_hours")
    assert daily.filter(total != 24).count() == 0


def test_catchment_weights_bounded_and_complete(spark):
    w = C._weights(spark, D)
    per_station = w.groupBy("station_complex_id").agg(F.sum("catchment_weight").alias("s")).collect()
    assert all(r.s <= 1.0 + 1e-12 for r in per_station)
    assert all(0 < r.s for r in per_station)


def test_scorecard_borough_rows_aggregate_clean_station_rows(spark):
    sc = C.scorecard(spark, D)
    st = sc.filter("record_type = 'station' AND data_quality_flag = 'clean'").groupBy("borough", "transit_year").agg(
        F.sum(F.col("annual_ridership").cast("decimal(18,2)")).cast("double").alias("a")
    )
    bo = sc.filter("record_type = 'borough'").select("borough", "transit_year", F.col("annual_ridership").alias("b"))
    j = st.join(bo, ["borough", "transit_year"], "full")
    assert j.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_equity_score_within_bounds(spark):
    eq = C.equity(spark, "/root/testdata/sf0.01", disruption=50.0)
    bad = eq.filter((F.col("equity_risk_score") < 0) | (F.col("equity_risk_score") > 100))
    assert bad.count() == 0
    assert eq.filter(F.col("equity_risk_score").isNotNull()).count() > 0


def test_upsert_is_idempotent(spark):
    ev = B.table(spark, D, "events").select("event_id", "ts", "value").withColumn("d", F.to_date("ts"))
    path = scratch_path(spark, "idem")
    ev.filter(F.col("event_id") % 2 == 0).write.partitionBy("d").parquet(path)
    batch = ev.filter(F.col("event_id") % 3 == 0).withColumn("value", F.col("value") * 2)
    inc.upsert_partitions(spark, path, batch, ["event_id"], "d")
    once = sorted(tuple(r) for r in spark.read.parquet(path).select("event_id", "value").collect())
    inc.upsert_partitions(spark, path, batch, ["event_id"], "d")
    twice = sorted(tuple(r) for r in spark.read.parquet(path).select("event_id", "value").collect())
    assert once == twice
    assert len({k for k, _ in once}) == len(once)


def test_chunked_lag_equals_plain_lag_with_a_hot_meter(spark):
    raw = B.meter_raw(spark, D)
    hot = raw.withColumn("scp", F.lit("HOT")).withColumn("c_a", F.lit("0")).withColumn("unit", F.lit("0")).withColumn("station", F.lit("S0"))
    ts = F.to_timestamp_ntz(F.concat_ws(" ", F.col("date").cast("string"), F.col("time")))
    r = hot.filter("description = 'REGULAR'").withColumn("t", ts).dropDuplicates(["t"])
    keys = ["c_a", "unit", "scp", "station"]
    plain = r.withColumn("p", F.lag("entries").over(Window.partitionBy(*keys).orderBy("t")))
    chunked = mtr.lag_chunked(r, keys, "t", ["entries"])
    a = sorted((x.t, x.p) for x in plain.select("t", "p").collect())
    b = sorted((x.t, x.prev_entries) for x in chunked.select("t", "prev_entries").collect())
    assert a == b


def test_polygon_cells_equal_rectangle_cells(spark):
    rect = B.tract_rectangles(spark, D)
    rings = rect.select(
        "geo_id",
        F.array(
            F.struct(F.col("xmin").alias("x"), F.col("ymin").alias("y")),
            F.struct(F.col("xmax").alias("x"), F.col("ymin").alias("y")),
            F.struct(F.col("xmax").alias("x"), F.col("ymax").alias("y")),
            F.struct(F.col("xmin").alias("x"), F.col("ymax").alias("y")),
        ).alias("ring"),
    )
    a = sorted(tuple(r) for r in ca.tract_cells(rect, 100.0).collect())
    b = sorted(tuple(r) for r in ca.tract_cells_polygon(rings, 100.0).collect())
    assert a == b


def test_catchment_weight_accuracy_at_25m(spark):
    """Cell weights vs a 5 m reference raster for an 800 m disc over 1 km square tracts."""
    rng = np.random.default_rng(7)
    centres = [(float(x), float(y)) for x, y in rng.uniform(1000, 4000, size=(8, 2))]
    ent = spark.createDataFrame([(str(i), x, y) for i, (x, y) in enumerate(centres)], "station_complex_id string, x double, y double")
    tracts = spark.createDataFrame(
        [(f"t{i}{j}", i * 1000.0, j * 1000.0, (i + 1) * 1000.0, (j + 1) * 1000.0) for i in range(6) for j in range(6)],
        "geo_id string, xmin double, ymin double, xmax double, ymax double",
    )
    w = ca.catchment_weights(ca.catchment_cells(ent, 800.0, 25.0), ca.tract_cells(tracts, 25.0))
    got = {(r.station_complex_id, r.geo_id): r.catchment_weight for r in w.collect()}
    errs = []
    step = 5.0
    for i, (cx, cy) in enumerate(centres):
        # the operator centres the disc on the entrance's 25 m cell centre
        ccx = (math.floor(cx / 25.0) + 0.5) * 25.0
        ccy = (math.floor(cy / 25.0) + 0.5) * 25.0
        xs = np.arange(ccx - 800 + step / 2, ccx + 800, step)
        ys = np.arange(ccy - 800 + step / 2, ccy + 800, step)
        gx, gy = np.meshgrid(xs, ys)
        inside = (gx - ccx) ** 2 + (gy - ccy) ** 2 <= 800.0**2
        tx, ty = np.floor(gx[inside] / 1000).astype(int), np.floor(gy[inside] / 1000).astype(int)
        total = inside.sum()
        keys, counts = np.unique(np.stack([tx, ty]), axis=1, return_counts=True)
        for (a, b), c in zip(keys.T, counts):
            errs.append(abs(got.get((str(i), f"t{a}{b}"), 0.0) - c / total))
    assert max(errs) < 0.015
