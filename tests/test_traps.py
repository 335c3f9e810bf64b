"""Hand-written micro fixtures for each behaviour trap of the warehouse models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.functions import initcap_words, null_greatest, null_least, rnd, safe_div
from stationflow.operators import catchment as ca
from stationflow.operators import congestion as cg
from stationflow.operators import marts as mt
from stationflow.operators import meters as mtr
from stationflow.operators import quality as dq
from stationflow.operators import recovery as rec
from stationflow.operators import utilization as ut
from stationflow.streaming import incremental as inc

STG_SCHEMA = (
    "station_complex_id string, station_name string, borough string, latitude double, longitude double, "
    "transit_year bigint, transit_month bigint, ridership double"
)


def test_initcap_splits_on_punctuation(spark):
    rows = [("174-175 STS (B,D)",), ("103 st (6)",), ("jamaica center-parsons/archer (e,j,z)",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(initcap_words("s")).collect()]
    assert got == ["174-175 Sts (B,D)", "103 St (6)", "Jamaica Center-Parsons/Archer (E,J,Z)", None]


def test_safe_divide_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.005, 1.0), (-2.5, 1.0)], "a double, b double")
    got = df.select(safe_div("a", "b").alias("q"), rnd(safe_div("a", "b"), 2).alias("r"), rnd(F.col("a"), 0).alias("r0")).collect()
    assert [r.q for r in got[:3]] == [None, None, None]
    assert got[3].r == 1.0  # 1.005 is below the tie in binary: both engines give 1.0 with this formula
    assert got[4].r0 == -3.0  # half away from zero


def test_least_greatest_propagate_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    got = df.select(null_least("a", "b").alias("l"), null_greatest("a", "b").alias("g")).collect()
    assert (got[0].l, got[0].g) == (None, None)
    assert (got[1].l, got[1].g) == (2.0, 3.0)


def _stg(spark, rows):
    return spark.createDataFrame(rows, STG_SCHEMA)


def test_baseline_flags_and_tiers(spark):
    cur = _stg(spark, [(s, s, "x", 40.0, -73.0, 2022, 1, float(v)) for s, v in
                       [("zero", 5), ("none", 5), ("m", 21), ("s", 2), ("r", 9), ("g", 7), ("l", 5)]])
    base = _stg(spark, [(s, s, "x", 40.0, -73.0, 2019, 1, float(v)) for s, v in
                        [("zero", 0), ("m", 10), ("s", 10), ("r", 10), ("g", 10), ("l", 10)]])
    out = {r.station_complex_id: r for r in rec.recovery_monthly(cur, base).collect()}
    assert out["zero"].monthly_recovery_pct is None and out["zero"].data_quality_flag == "clean"
    assert out["zero"].recovery_tier == "Critical"  # NULL falls into ELSE, as in the warehouse
    assert out["none"].data_quality_flag == "no_baseline"
    assert out["m"].data_quality_flag == "suspect_merged"
    assert out["s"].data_quality_flag == "suspect_split"
    assert [out[k].recovery_tier for k in ("r", "g", "l")] == ["Recovered", "Recovering", "Lagging"]
    explicit = {r.station_complex_id: r.recovery_tier for r in rec.recovery_monthly(cur, base, null_tier="N/A").collect()}
    assert explicit["zero"] == "N/A"


def test_lag_gap_row_vs_strict(spark):
    cur = _stg(spark, [("a", "a", "x", 40.0, -73.0, 2022, 1, 10.0), ("a", "a", "x", 40.0, -73.0, 2022, 3, 20.0)])
    m = rec.monthly_totals(cur)
    row = {r.ridership_month_date.month: r for r in rec.mom_change(m).collect()}
    strict = {r.ridership_month_date.month: r for r in rec.mom_change(m, strict=True).collect()}
    assert row[3].prev_month_ridership == 10.0 and row[3].month_over_month_pct == 100.0
    assert strict[3].prev_month_ridership is None


def test_meter_first_reset_and_cap(spark):
    rows = [
        ("1", "u", "s", "st", "l", "d", dt.date(2019, 1, 1), "08:00:00", "REGULAR", 100, 0),
        ("1", "u", "s", "st", "l", "d", dt.date(2019, 1, 1), "12:00:00", "REGULAR", 150, 0),
        ("1", "u", "s", "st", "l", "d", dt.date(2019, 1, 1), "16:00:00", "REGULAR", 40, 0),
        ("1", "u", "s", "st", "l", "d", dt.date(2019, 1, 1), "23:00:00", "REGULAR", 9000, 0),
        ("1", "u", "s", "st", "l", "d", dt.date(2019, 1, 2), "01:00:00", "REGULAR", 9010, 0),
        ("1", "u", "s", "st", "l", "d", dt.date(2019, 1, 2), "02:00:00", "RECOVR AUD", 1, 0),
    ]
    df = spark.createDataFrame(rows, "c_a string, unit string, scp string, station string, line_name string, division string, "
                                     "date date, time string, description string, entries bigint, exits bigint")
    got = [r.entries_delta for r in mtr.meter_delta(df, entries_cap=5000).orderBy("turnstile_timestamp").collect()]
    assert got == [None, 50, None, None, 10]  # the 01:00 row takes its previous reading from the day before


def test_rolling_zero_count_and_streak(spark):
    vals = [0, 5, 0, 0, 0]
    dense = spark.createDataFrame([("s", dt.date(2024, 1, 1), h, float(v), 0) for h, v in enumerate(vals)],
                                  "station_complex_id string, transit_date date, transit_hour bigint, hourly_ridership double, is_gap_hour int")
    rz = [r.consecutive_zero_count for r in ut.rolling_zero_count(dense).orderBy("transit_hour").collect()]
    zs = [r.zero_streak for r in ut.zero_streaks(dense).orderBy("transit_hour").collect()]
    assert rz == [1, 1, 2, 2, 3]
    assert zs == [1, 0, 1, 2, 3]


def test_dense_rank_ties_share_peak(spark):
    hub = spark.createDataFrame(
        [("s", "S", "b", 40.0, -73.0, dt.date(2024, 1, 1), h, 2, float(v), 1) for h, v in zip([6, 7, 8, 9, 23], [9, 9, 7, 5, 3])],
        "station_complex_id string, station_name string, borough string, latitude double, longitude double, transit_date date, "
        "transit_hour bigint, day_of_week bigint, hourly_ridership double, fare_rows bigint",
    )
    got = [r.hour_classification for r in cg.congestion_hourly(hub).orderBy("transit_hour").collect()]
    assert got == ["Peak Hour", "Peak Hour", "Near Peak", "Near Peak", "Overnight"]


def test_lower_median_and_mode_tie(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 2.0), ("b", 3.0)], "g string, x double")
    med = {r.g: r.m for r in df.groupBy("g").agg(cg.lower_median("x").alias("m")).collect()}
    assert med == {"a": 1.0, "b": 2.0}
    modes = spark.createDataFrame([("g", v) for v in (8, 8, 17, 17, None)], "g string, h bigint")
    assert cg.top_value_per_group(modes, ["g"], "h").first().top_value == 8


def test_weighted_mean_null_aware_vs_not(spark):
    df = spark.createDataFrame([("s", 10.0, 1), ("s", None, 1)], "s string, x double, w bigint")
    aware = ca.weighted_mean(df, ["s"], "x", "w", null_aware=True).first()[1]
    unaware = ca.weighted_mean(df, ["s"], "x", "w", null_aware=False).first()[1]
    assert (aware, unaware) == (10.0, 5.0)


def test_equity_null_component_gives_null_score(spark):
    sc = spark.createDataFrame(
        [("station", 2024, "b", "s1", "S1", 40.0, -73.0, 100.0, 50.0, 80.0, "clean", 60.0),
         ("station", 2024, "b", "s2", "S2", 40.0, -73.0, 100.0, None, 80.0, "clean", None),
         ("station", 2024, "b", "s3", "S3", 40.0, -73.0, 100.0, 100.0, 80.0, "clean", 60.0),
         ("station", 2024, "b", "s4", "S4", 40.0, -73.0, 100.0, 40.0, 80.0, "clean", 60.0)],
        "record_type string, transit_year bigint, borough string, station_complex_id string, station_name string, latitude double, "
        "longitude double, annual_ridership double, recovery_pct double, annual_baseline_2019 double, data_quality_flag string, "
        "borough_avg_recovery_pct double",
    )
    annual = spark.createDataFrame([("s1", 2024, 10.0, 5.0), ("s2", 2024, 10.0, 5.0), ("s4", 2024, 10.0, 20.0)],
                                   "station_complex_id string, transit_year bigint, avg_demand_intensity double, disruption_rate_per_1k_hours double")
    demo = spark.createDataFrame([("s1", 50000.0, 0.1, "Middle Income"), ("s2", 50000.0, 0.1, "Middle Income"),
                                  ("s3", None, None, None), ("s4", 30000.0, 0.3, "Low Income")],
                                 "station_complex_id string, weighted_mean_income double, weighted_poverty_rate double, income_tier string")
    out = {r.station_complex_id: r for r in mt.equity_score(sc, annual, demo).collect()}
    assert out["s1"].equity_risk_score == 16.5 + 16.5 + 17.0
    assert out["s2"].equity_risk_score is None and out["s2"].equity_risk_tier is None
    assert out["s3"].equity_risk_score is None  # no utilisation row and no income
    assert out["s4"].equity_risk_score == 100.0 and out["s4"].equity_risk_tier == "High Risk"
    faithful = {r.station_complex_id: r.equity_risk_tier for r in mt.equity_score(sc, annual, demo, null_tier="__else__").collect()}
    assert faithful["s2"] == "Low Risk"


def test_merge_newest_wins_without_duplicates(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k bigint, p string, v double")
    batch = spark.createDataFrame([(2, "b", 20.0, 1), (2, None, 21.0, 2), (3, "c", 3.0, 1)], "k bigint, p string, v double, ver int")
    out = {r.k: r for r in inc.incremental_upsert(target, batch, ["k"], ["ver"]).collect()}
    assert sorted(out) == [1, 2, 3]
    assert out[2].v == 21.0 and out[1].v == 1.0


def test_anti_join_reports_orphans_despite_null_parent(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in dq.orphan_keys(child, parent, "k").collect()] == ["b"]


def test_tiers_null_policy(spark):
    from stationflow.functions import below_tier, tier

    df = spark.createDataFrame([(None,), (95.0,), (10.0,)], "x double")
    got = df.select(
        tier("x", ((90, "A"),), "Z").alias("faithful"),
        tier("x", ((90, "A"),), "Z", None).alias("keep_null"),
        below_tier("x", ((50, "low"),), "high", "n/a").alias("labelled"),
    ).collect()
    assert [tuple(r) for r in got] == [("Z", None, "n/a"), ("A", "A", "high"), ("Z", "Z", "low")]


@pytest.mark.parametrize("delay_ok", [True])
def test_contract_gold_rejects_schema_drift(spark, delay_ok):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, "a")], "a bigint, b string")
    assert dq.contract_gold(df, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])) is df
    with pytest.raises(dq.ContractViolation):
        dq.contract_gold(df, T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())]))


# ------------------------------------------------------------------ nothing is dropped
def test_rounding_of_large_values(spark):
    df = spark.createDataFrame([(1e14,), (1e17,), (-9.007199254740993e15,), (123.456789,), (None,)], "x double")
    got = [tuple(r) for r in df.select(rnd("x", 6), rnd("x", 2), rnd("x", 0)).collect()]
    assert got[:3] == [(1e14,) * 3, (1e17,) * 3, (-9.007199254740992e15,) * 3]
    assert got[3] == (123.456789, 123.46, 123.0) and got[4] == (None, None, None)


def test_split_crosswalk_keeps_the_whole(spark):
    base = _stg(spark, [("a", "a", "x", 40.0, -73.0, 2019, 1, 0.01)] * 1000)
    cur = _stg(spark, [(s, s, "x", 40.0, -73.0, 2022, 1, 1.0) for s in ("p", "q", "r")])
    third = [("a", "p", 0.333333), ("a", "q", 0.333333), ("a", "r", 0.333334)]
    out = rec.crosswalk_recovery(cur, base, spark.createDataFrame(third, "old_id string, new_id string, share double")).collect()
    parts = [r.baseline_monthly_2019 for r in out]
    assert round(sum(parts), 2) == 10.0 and sorted(parts) == [3.33, 3.33, 3.34]


def test_upsert_moves_a_key_and_resumes(spark):
    from stationflow.session import scratch_path

    path, stage = scratch_path(spark, "moved"), scratch_path(spark, "moved-stage")
    rows = spark.createDataFrame([(1, "2024-01-01", 1.0), (2, "2024-01-01", 1.0), (3, "2024-01-03", 1.0)], "id int, d string, v double")
    rows = rows.withColumn("d", F.to_date("d"))
    rows.write.partitionBy("d").parquet(path)
    batch = spark.createDataFrame([(1, "2024-01-02", 2.0), (3, "2024-01-02", 2.0)], "id int, d string, v double").withColumn("d", F.to_date("d"))
    inc.upsert_partitions(spark, path, batch, ["id"], "d", stage=stage)
    read = lambda: sorted((r.id, str(r.d), r.v) for r in spark.read.parquet(path).collect())
    expected = [(1, "2024-01-02", 2.0), (2, "2024-01-01", 1.0), (3, "2024-01-02", 2.0)]
    assert read() == expected
    # a second run of the same upsert applies its whole stage again, even if a partition was lost meanwhile
    inc._delete(spark, f"{path}/d=2024-01-01")
    inc.upsert_partitions(spark, path, batch, ["id"], "d", stage=stage)
    assert read() == expected


def test_corrupt_lines_are_carried(spark, tmp_path):
    from stationflow.sources import bronze

    (tmp_path / "year=2024").mkdir()
    (tmp_path / "year=2024" / "x.csv").write_text("a,b\n1,2\n1,2,3\n")
    df = bronze.read_bronze(spark, str(tmp_path), bronze.string_schema(["a", "b"]), corrupt_col="_bad").cache()
    assert {(r.a, r.b, r._bad) for r in df.collect()} == {("1", "2", None), ("1", "2", "1,2,3")}


def test_census_documents_are_never_lost(spark):
    from stationflow.sources import census

    docs = ['[["NAME","tract"],["a","1"],["b","2","x"]]', "not json", "", None, "[]", '[["NAME","tract"]]']
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    assert [tuple(r) for r in census.rows_from_header_json(df, columns=["NAME", "tract"]).collect()] == [("a", "1")]
    rejects = sorted((r.reject_reason, r.row) for r in census.census_rejects(df).collect())
    assert rejects == sorted([("cell_count", 2), ("malformed", None), ("empty", None), ("empty", None), ("no_header", None)])


def test_quantiles_without_a_buffer(spark):
    from stationflow.operators.common import exact_quantiles

    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("k"), F.pow(F.col("id") % 997, 2).alias("v"))
    qs = (0.0, 0.25, 0.5, 0.95, 1.0)
    got = {r.k: tuple(r)[3:] for r in exact_quantiles(df, ["k"], "v", qs, parts=8).collect()}
    plain = {r.k: tuple(r.q) for r in df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(q) for q in qs])).alias("q")).collect()}
    assert got == plain
    assert exact_quantiles(df.limit(0), [], "v", qs).count() == 0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from stationflow.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(_key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_operators_on_a_table_with_other_names(spark):
    from stationflow.operators import staging as stg
    from stationflow.sources import bindings as B
    from conftest import SF_SMALL

    names = {"station_complex_id": "gare_id", "ridership": "voyageurs", "transit_timestamp": "quand", "borough": "quartier"}
    raw = B.hourly_fine_raw(spark, SF_SMALL)
    other = raw.withColumnsRenamed(names)
    staged = stg.stg_ridership(stg.canonical(other, **names))
    plain = stg.stg_ridership(raw)
    hub, hub2 = cg.fare_consolidated(staged), cg.fare_consolidated(plain)
    for a, b in ((rec.monthly_totals(staged), rec.monthly_totals(plain)), (cg.congestion_hourly(hub), cg.congestion_hourly(hub2)),
                 (ut.hour_spine(hub), ut.hour_spine(hub2))):
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_contract_gate_splits_rows(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 1.0), ("b", -1.0), ("z", None)], "k string, v double")
    rules = (dq.ColumnContract("k", "string", nullable=False, values=("a", "b")), dq.ColumnContract("v", "double", nullable=False, min_value=0))
    good, bad = dq.contract_gate(df, rules)
    assert [r.k for r in good.collect()] == ["a"]
    assert sorted(r.reject_reason for r in bad.collect()) == ["k:domain,v:null", "k:null", "v:range"]
    with pytest.raises(dq.ContractViolation):
        dq.contract_gate(df, (dq.ColumnContract("v", "string"),))
