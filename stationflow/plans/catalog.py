"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Each entry binds the shared test tables to an operator's canonical input
(``stationflow.sources.bindings``) and applies the operator. The matching
DuckDB statement lives under the same key in ``stationflow.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions import rnd
from stationflow.operators import catchment as ca
from stationflow.operators import congestion as cg
from stationflow.operators import crosswalk as cw
from stationflow.operators import geometry as geo
from stationflow.operators import marts as mt
from stationflow.operators import meters as mtr
from stationflow.operators import profile as prof
from stationflow.operators import quality as dq
from stationflow.operators import recovery as rec
from stationflow.operators import staging as stg
from stationflow.operators import summaries as sm
from stationflow.operators import utilization as ut
from stationflow.session import materialize, scratch_path
from stationflow.sources import bindings as B
from stationflow.sources import bronze, census
from stationflow.streaming import incremental as inc
from stationflow.streaming import live, stateful
from stationflow.streaming.versions import VersionedTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# ------------------------------------------------------------------ inputs
def stg_all(spark, d, normalize_names=False):
    """Staged B1 rows; names are normalised downstream unless the rows themselves are the output."""
    return stg.stg_ridership(B.ridership_monthly_raw(spark, d), normalize_names)


def stg_cur(spark, d, normalize_names=False):
    """Every year but the baseline."""
    return stg_all(spark, d, normalize_names).filter(F.col("transit_year") != B.BASELINE_YEAR)


def stg_base(spark, d):
    return stg_all(spark, d).filter(F.col("transit_year") == B.BASELINE_YEAR)


def monthly(spark, d, totals=None):
    """Monthly recovery from one scan holding both the current and the baseline years.

    ``totals`` (station x year x month rows of every year, see
    :func:`monthly_all`) lets several consumers share one aggregate.
    """
    if totals is None:
        return rec.recovery_monthly(stg_all(spark, d), baseline_year=B.BASELINE_YEAR)
    return rec.recovery_from_monthly(totals, baseline_year=B.BASELINE_YEAR)


def monthly_all(spark, d):
    """Station x year x month totals of the whole B1 source, written once for several consumers."""
    return materialize(rec.monthly_totals(stg_all(spark, d)), "monthly-totals")


# ------------------------------------------------------------------ recovery
@register("monthly_totals")
def q_monthly_totals(spark, d):
    return rec.monthly_totals(stg_cur(spark, d))


@register("recovery_monthly")
def q_recovery_monthly(spark, d):
    return monthly(spark, d)


@register("mom_change")
def q_mom_change(spark, d):
    return rec.mom_change(rec.monthly_totals(stg_cur(spark, d)))


@register("mom_change_strict")
def q_mom_change_strict(spark, d):
    return rec.mom_change(rec.monthly_totals(stg_cur(spark, d)), strict=True)


@register("recovery_borough")
def q_recovery_borough(spark, d):
    return rec.recovery_borough(monthly(spark, d))


@register("recovery_scorecard")
def q_recovery_scorecard(spark, d):
    return rec.recovery_scorecard(monthly(spark, d))


@register("crosswalk_recovery")
def q_crosswalk_recovery(spark, d):
    # Baseline ids re-keyed k -> k // 2 (many-to-one), derived from the data's own station ids.
    ids = stg_base(spark, d).select("station_complex_id").distinct()
    cw = ids.select(
        F.col("station_complex_id").alias("old_id"),
        (F.col("station_complex_id").cast("bigint") / 2).cast("bigint").cast("string").alias("new_id"),
        F.lit(1.0).alias("share"),
    )
    return rec.crosswalk_recovery(stg_cur(spark, d), stg_base(spark, d), cw)


@register("crosswalk_split")
def q_crosswalk_split(spark, d):
    # Each baseline id k splits: a third stays with k, two thirds go to (k + 1) % 20.
    ids = stg_base(spark, d).select("station_complex_id").distinct()
    k = F.col("station_complex_id").cast("bigint")
    part = lambda new, share: ids.select(F.col("station_complex_id").alias("old_id"), new.cast("string").alias("new_id"), F.lit(share).alias("share"))
    cw = part(k, 0.333333).unionByName(part((k + 1) % 20, 0.666667))
    return rec.crosswalk_recovery(stg_cur(spark, d), stg_base(spark, d), cw)


def _dated_crosswalk(spark, d):
    """Links between the data's own stations: chains over several dates, a split, and a cycle that lasts two months."""
    ids = stg_all(spark, d).select("station_complex_id").distinct()
    k = F.col("station_complex_id").cast("bigint")

    def link(when, new, share, since, until):
        day = lambda x: F.lit(x).cast("date")
        return ids.filter(when).select(
            F.col("station_complex_id").alias("old_id"), new.cast("string").alias("new_id"), F.lit(share).alias("share"),
            day(since).alias("valid_from"), day(until).alias("valid_to"),
        )

    links = link(k % 4 == 0, k + 1, 1.0, "2019-07-10", None)
    links = links.unionAll(link(k % 4 == 1, k + 1, 0.75, "2020-01-01", "2021-06-15"))
    links = links.unionAll(link(k % 4 == 1, k + 2, 0.25, "2020-01-01", "2021-06-15"))
    links = links.unionAll(link(k % 4 == 2, k + 1, 1.0, "2021-01-01", None))
    return links.unionAll(link(k == 19, k - 1, 1.0, "2021-03-01", "2021-05-01"))


@register("crosswalk_chain")
def q_crosswalk_chain(spark, d):
    return cw.rekeyed_monthly(stg_all(spark, d), materialize(cw.crosswalk_periods(_dated_crosswalk(spark, d)), "crosswalk"))


@register("crosswalk_cycles")
def q_crosswalk_cycles(spark, d):
    return cw.crosswalk_faults(cw.crosswalk_periods(_dated_crosswalk(spark, d)))


# ------------------------------------------------------------------ staging
@register("ridership_all")
def q_ridership_all(spark, d):
    s = stg_cur(spark, d, True)
    recent = F.col("transit_year") >= 2025
    return stg.ridership_all(s.filter(~recent), s.filter(recent).drop("transfers"))


@register("stg_ridership")
def q_stg_ridership(spark, d):
    return stg.stg_ridership(B.ridership_monthly_raw(spark, d, with_defects=True))


@register("stg_rejects")
def q_stg_rejects(spark, d):
    r = stg.stg_rejects(B.ridership_monthly_raw(spark, d, with_defects=True))
    return r.select("transit_timestamp", "station_complex_id", "ridership", "reject_reason")


@register("stg_census")
def q_stg_census(spark, d):
    return stg.stg_census(B.census_raw(spark, d))


@register("season_totals")
def q_season_totals(spark, d):
    return stg.season_totals(stg_all(spark, d))


# ------------------------------------------------------------------ congestion
def stg_coarse(spark, d, normalize_names=False):
    return stg.stg_ridership(B.hourly_coarse_raw(spark, d), normalize_names)


def stg_fine(spark, d):
    return stg.stg_ridership(B.hourly_fine_raw(spark, d), normalize_names=False)


def hub_coarse(spark, d):
    return cg.fare_consolidated(stg_coarse(spark, d))


def hub_fine(spark, d):
    return cg.fare_consolidated(stg_fine(spark, d))


@register("fare_consolidated")
def q_fare_consolidated(spark, d):
    return hub_coarse(spark, d)


@register("system_hourly")
def q_system_hourly(spark, d):
    return cg.system_hourly(hub_coarse(spark, d))


@register("peak_rank")
def q_peak_rank(spark, d):
    return cg.peak_rank(hub_coarse(spark, d))


@register("congestion_hourly")
def q_congestion_hourly(spark, d):
    return cg.congestion_hourly(hub_coarse(spark, d))


@register("congestion_hourly_distinct")
def q_congestion_hourly_distinct(spark, d):
    return cg.congestion_hourly(hub_coarse(spark, d), hours="distinct")


def _halves(spark, d):
    s = stg_coarse(spark, d)
    split = F.lit(B.SPLIT_DATE).cast("date")
    return s.filter(F.col("transit_date") >= split), s.filter(F.col("transit_date") < split)


@register("capacity_p95")
def q_capacity_p95(spark, d):
    return cg.capacity_p95(stg_coarse(spark, d))


@register("capacity_p95_fare_rows")
def q_capacity_p95_fare_rows(spark, d):
    return cg.capacity_p95(stg_coarse(spark, d), consolidate=False)


@register("top_value_per_group")
def q_top_value_per_group(spark, d):
    h = cg.congestion_hourly(hub_coarse(spark, d))
    return cg.top_value_per_group(h, ["station_complex_id", "day_of_week"], "station_peak_hour", "most_common_peak_hour")


@register("top_value_from_sketches")
def q_top_value_from_sketches(spark, d):
    """The groups of ``top_value_per_group``, from each station's days by way of its weeks."""
    h = cg.congestion_hourly(hub_coarse(spark, d)).withColumn("week", F.to_date(F.date_trunc("week", "transit_date")))
    days, weeks, keys = ["station_complex_id", "day_of_week", "week", "transit_date"], ["station_complex_id", "day_of_week", "week"], ["station_complex_id", "day_of_week"]
    stored = materialize(sm.value_counts(h, days, "hour_classification", 2), "value-counts")
    by_week = sm.merge_counts(stored, days, weeks, 2)
    return sm.read_top_value(sm.merge_counts(by_week, weeks, keys, 2), keys, "most_common_period")


QUANTILE_CELLS = 200


@register("quantiles_from_sketches")
def q_quantiles_from_sketches(spark, d):
    """Ridership quantiles of station-years, stations and the system from the points of station-days."""
    grains = (["station_complex_id", "transit_year", "transit_month"], ["station_complex_id", "transit_year"], ["station_complex_id"], [])
    rows = stg_all(spark, d)
    points = sm.quantile_points(rows, ["station_complex_id", "transit_year", "transit_month", "transit_date"], "ridership", QUANTILE_CELLS)
    steps, out = 1, None
    for keys in grains:
        points = materialize(sm.merge_points(points, keys, QUANTILE_CELLS), "quantile-points")
        steps += 1
        read = sm.read_quantiles(points, keys, (0.25, 0.5, 0.95), ("p25", "p50", "p95"))
        missing = [F.lit(None).cast(t).alias(c) for c, t in (("station_complex_id", "string"), ("transit_year", "bigint"), ("transit_month", "bigint")) if c not in keys]
        read = read.select("*", *missing, F.lit(steps / QUANTILE_CELLS).alias("rank_error"))
        out = read if out is None else out.unionByName(read)
    return out


def _mart(spark, d, **kw):
    cur, base = _halves(spark, d)
    hub = materialize(cg.fare_consolidated(cur))  # read by the hourly scores and the station dimension
    return cg.congestion_mart(cg.congestion_hourly(hub), cg.capacity_p95(base), cg.station_dim(hub), **kw)


@register("congestion_mart")
def q_congestion_mart(spark, d):
    return _mart(spark, d)


@register("congestion_mart_low")
def q_congestion_mart_low(spark, d):
    return _mart(spark, d, intensity=((4.0, "High Congestion"), (3.0, "Moderate"), (1.0, "Baseline")))


@register("station_thresholds")
def q_station_thresholds(spark, d):
    return cg.station_thresholds(hub_coarse(spark, d))


# ------------------------------------------------------------------ utilization
def _status(spark, d, min_avg=50):
    hub = materialize(hub_fine(spark, d))  # read by the spine, the profile and the station dimension
    return ut.utilization_status(ut.hour_spine(hub), ut.hour_profile(hub), min_avg=min_avg), hub


@register("hour_spine")
def q_hour_spine(spark, d):
    return ut.hour_spine(hub_fine(spark, d))


@register("hour_profile")
def q_hour_profile(spark, d):
    return ut.hour_profile(materialize(hub_fine(spark, d)))  # the hub feeds two aggregates


@register("rolling_zero_count")
def q_rolling_zero_count(spark, d):
    return ut.rolling_zero_count(ut.hour_spine(hub_fine(spark, d)))


@register("zero_streaks")
def q_zero_streaks(spark, d):
    return ut.zero_streaks(ut.hour_spine(hub_fine(spark, d)))


@register("active_stations_rollup")
def q_active_stations_rollup(spark, d):
    hub = hub_fine(spark, d)
    return cg.active_stations_rollup(materialize(cg.station_bitmaps(hub, cg.station_numbers(hub)), "station-bitmaps"))


@register("station_hour_thresholds")
def q_station_hour_thresholds(spark, d):
    return cg.station_hour_thresholds(hub_coarse(spark, d))


@register("outage_episodes")
def q_outage_episodes(spark, d):
    return ut.outage_episodes(materialize(ut.hour_spine(hub_fine(spark, d)), "spine"))


@register("outage_episodes_years")
def q_outage_episodes_years(spark, d):
    """Over the years of B1, whose stations are reported at one hour of a day: runs over day and month borders."""
    return ut.outage_episodes(materialize(ut.hour_spine(cg.fare_consolidated(stg_all(spark, d))), "spine"))


@register("utilization_status")
def q_utilization_status(spark, d):
    return _status(spark, d)[0]


def daily_fine(spark, d):
    st, hub = _status(spark, d)
    return ut.utilization_daily(st, cg.station_dim(hub))


@register("utilization_daily")
def q_utilization_daily(spark, d):
    return daily_fine(spark, d)


@register("utilization_annual")
def q_utilization_annual(spark, d):
    return ut.utilization_annual(daily_fine(spark, d))


# ------------------------------------------------------------------ catchment
GEO_RADIUS_M = B.GEO_RADIUS_CELLS * B.GEO_CELL_M


def stations(spark, d, totals=None):
    """Station dimension of the B1 ridership rows (read by entrances and by the demographics).

    From the shared monthly totals when given (a rollup of a small table),
    else from the staged rows.
    """
    if totals is not None:
        return cg.station_dim(totals)
    return materialize(cg.station_dim(stg_all(spark, d)), "stations")


def _cc(spark, d, dim=None):
    dim = stations(spark, d) if dim is None else dim
    return ca.catchment_cells(B.station_entrances(dim), radius=GEO_RADIUS_M, cell=B.GEO_CELL_M)


def _tc(spark, d):
    tracts = ca.load_tracts(B.tract_rectangles(spark, d), "36", ["005", "047", "061", "081", "085"])
    return ca.tract_cells(tracts, cell=B.GEO_CELL_M)


def _weights(spark, d, dim=None):
    return ca.catchment_weights(_cc(spark, d, dim), _tc(spark, d))


def demographics(spark, d, totals=None):
    census = stg.stg_census(B.census_raw(spark, d))
    dim = stations(spark, d, totals)
    return ca.catchment_demographics(_weights(spark, d, dim), census, dim)


@register("catchment_cells")
def q_catchment_cells(spark, d):
    return _cc(spark, d)


@register("tract_cells")
def q_tract_cells(spark, d):
    return _tc(spark, d)


@register("tract_cells_polygon")
def q_tract_cells_polygon(spark, d):
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"))
    return ca.tract_cells_polygon(B.tract_rectangles(spark, d).select("geo_id", ring.alias("ring")), cell=B.GEO_CELL_M)


@register("tract_cells_rings")
def q_tract_cells_rings(spark, d):
    """Quadtree cells of tracts with holes, with the exact area that the tract covers of each."""
    cells = geo.covering(B.tract_shapes(spark, d), "geo_id")
    return cells.select("geo_id", *geo.CELL, "inside", rnd(F.col("area"), 2).alias("area"))


@register("catchment_weights_clipped")
def q_catchment_weights_clipped(spark, d):
    """Exact shares of catchments (united discs around the entrances) and of tracts with holes."""
    entrances = B.station_entrances(stations(spark, d)).withColumn("part", geo.disc(F.col("x"), F.col("y"), GEO_RADIUS_M))
    # a station has a bounded number of entrances
    buffers = entrances.groupBy("station_complex_id").agg(F.collect_list("part").alias("parts"))
    catchments = materialize(geo.covering(buffers, "station_complex_id"), "catchment-cover")
    tracts = materialize(geo.covering(B.tract_shapes(spark, d), "geo_id"), "tract-cover")
    w = geo.clipped_weights(catchments, tracts)
    areas, shares = ("intersect_area", "buffer_area", "tract_area"), ("catchment_weight", "tract_coverage_pct")
    rounded = [rnd(F.col(c), 2).alias(c) for c in areas] + [rnd(F.col(c), 6).alias(c) for c in shares]
    return w.select("station_complex_id", "geo_id", *rounded).filter("intersect_area > 0")


@register("catchment_latlon")
def q_catchment_latlon(spark, d):
    """Catchments around the stations' own coordinates, through the local projection."""
    xy = ca.project_xy(stations(spark, d), "latitude", "longitude", B.GEO_LAT0, B.GEO_LON0)
    return ca.catchment_cells(xy, radius=GEO_RADIUS_M, cell=B.GEO_CELL_M)


@register("catchment_head_count")
def q_catchment_head_count(spark, d):
    return ca.catchment_head_count(_weights(spark, d), stg.stg_census(B.census_raw(spark, d)))


@register("catchment_weights")
def q_catchment_weights(spark, d):
    return _weights(spark, d)


@register("weighted_mean")
def q_weighted_mean(spark, d):
    w = _weights(spark, d)
    census = stg.stg_census(B.census_raw(spark, d)).select(F.col("geoid").alias("geo_id"), "poverty_rate")
    j = w.join(census, "geo_id", "left")
    return j.groupBy("station_complex_id").agg(
        rnd(ca.weighted_mean_expr("poverty_rate", "intersect_cells", null_aware=True), 6).alias("null_aware"),
        rnd(ca.weighted_mean_expr("poverty_rate", "intersect_cells", null_aware=False), 6).alias("null_unaware"),
    )


@register("catchment_demographics")
def q_catchment_demographics(spark, d):
    return demographics(spark, d)


# ------------------------------------------------------------------ marts
def scorecard(spark, d, totals=None):
    return rec.recovery_scorecard(monthly(spark, d, totals))


def annual_fine(spark, d):
    return ut.utilization_annual(daily_fine(spark, d))


def equity(spark, d, disruption=10.0, totals=None):
    # one aggregate of the B1 source feeds both the scorecard and the station dimension
    totals = monthly_all(spark, d) if totals is None else totals
    return mt.equity_score(
        scorecard(spark, d, totals), annual_fine(spark, d), demographics(spark, d, totals), disruption=disruption
    )


@register("equity_score")
def q_equity_score(spark, d):
    return equity(spark, d, disruption=50.0)


@register("equity_score_default")
def q_equity_score_default(spark, d):
    return equity(spark, d)


def _fine_mart(spark, d):
    s = stg_fine(spark, d)
    split = F.lit(B.SPLIT_DATE).cast("date")
    hub = materialize(cg.fare_consolidated(s))
    cap = cg.capacity_p95(s.filter(F.col("transit_date") < split))
    return cg.congestion_mart(cg.congestion_hourly(hub), cap, cg.station_dim(hub)), hub


@register("efficiency_matrix")
def q_efficiency_matrix(spark, d):
    mart, _ = _fine_mart(spark, d)
    return mt.efficiency_matrix(
        mart, scorecard(spark, d), high_index=3.0, intensity=((4.0, "High Congestion"), (3.0, "Moderate"), (1.0, "Baseline"))
    )


# ------------------------------------------------------------------ KPIs
@register("kpi_disruption_intensity")
def q_kpi_disruption_intensity(spark, d):
    return mt.kpi_disruption_intensity(daily_fine(spark, d))


@register("kpi_disruption_share")
def q_kpi_disruption_share(spark, d):
    return mt.kpi_disruption_share(daily_fine(spark, d))


@register("kpi_disruption_yoy")
def q_kpi_disruption_yoy(spark, d):
    # The event table spans one month, so the period-over-period KPI runs weekly here.
    return mt.kpi_disruption_change(daily_fine(spark, d), period="week")


@register("kpi_disruption_yearly")
def q_kpi_disruption_yearly(spark, d):
    """Year over year, over the years of B1; a disruption needs riders at the hour on an average day, so the threshold is low."""
    hub = cg.fare_consolidated(stg_all(spark, d))
    dense = ut.hour_spine(hub)
    status = ut.utilization_status(dense, ut.hour_profile(hub), quiet=(25, 25), zero_rate=2.0, min_avg=-1, min_zeros=2)
    hours = status.filter(F.col("utilization_status") == "Possible Disruption").groupBy("station_complex_id", "transit_date").agg(F.count(F.lit(1)).alias("disruption_hours"))
    dim = stations(spark, d).select(F.col("station_complex_id").alias("_s"), "borough")
    daily = hours.join(dim, F.col("station_complex_id") == F.col("_s"), "left")
    return mt.kpi_disruption_change(daily, period="year")


@register("kpi_risk_profile")
def q_kpi_risk_profile(spark, d):
    return mt.kpi_risk_profile(equity(spark, d, disruption=50.0))


@register("kpi_quality_counts")
def q_kpi_quality_counts(spark, d):
    return mt.kpi_quality_counts(scorecard(spark, d))


@register("kpi_income_gap")
def q_kpi_income_gap(spark, d):
    return mt.kpi_income_gap(demographics(spark, d))


@register("kpi_system_recovery")
def q_kpi_system_recovery(spark, d):
    return mt.kpi_system_recovery(monthly(spark, d))


@register("kpi_row_reduction")
def q_kpi_row_reduction(spark, d):
    cur, base = _halves(spark, d)
    hub = materialize(cg.fare_consolidated(cur))
    hourly = materialize(cg.congestion_hourly(hub))
    return mt.kpi_row_reduction(hourly, cg.congestion_mart(hourly, cg.capacity_p95(base), cg.station_dim(hub)))


@register("kpi_index_by_class")
def q_kpi_index_by_class(spark, d):
    return mt.kpi_index_by_class(cg.congestion_hourly(hub_coarse(spark, d)))


# ------------------------------------------------------------------ meters, profiles
@register("meter_delta")
def q_meter_delta(spark, d):
    return mtr.meter_delta(B.meter_raw(spark, d), entries_cap=200)


@register("meter_delta_default")
def q_meter_delta_default(spark, d):
    return mtr.meter_delta(B.meter_raw(spark, d))


@register("quantile_profile")
def q_quantile_profile(spark, d):
    return prof.quantile_profile(mtr.meter_delta(B.meter_raw(spark, d), entries_cap=200), "entries_delta")


@register("income_profile")
def q_income_profile(spark, d):
    return prof.income_profile(stg.stg_census(B.census_raw(spark, d)))


# ------------------------------------------------------------------ quality
REFERENCE_BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")


@register("dq_not_null")
def q_dq_not_null(spark, d):
    return dq.dq_not_null(stg_all(spark, d), ["transit_timestamp", "station_complex_id", "ridership", "borough", "latitude"], "stg_ridership")


@register("dq_unique")
def q_dq_unique(spark, d):
    m = materialize(rec.monthly_totals(stg_cur(spark, d)), "monthly-unique")  # read by both rules
    return dq.dq_unique(m, ["station_complex_id", "ridership_year", "ridership_month"], "monthly_totals").unionByName(
        dq.dq_unique(m, ["station_complex_id", "ridership_month"], "monthly_totals", severity="warn")
    )


@register("dq_accepted_values")
def q_dq_accepted_values(spark, d):
    m = monthly(spark, d)
    return dq.run_checks(m, "recovery_monthly", [
        dq.Check("accepted_values", "data_quality_flag", ("clean", "suspect_merged", "suspect_split", "no_baseline")),
        dq.Check("accepted_values", "recovery_tier", ("Recovered", "Recovering", "Lagging", "Critical")),
        dq.Check("accepted_values", "borough", REFERENCE_BOROUGHS, severity="warn"),
        dq.Check("accepted_values", "recovery_tier", ("Recovered", "Recovering"), where="data_quality_flag = 'clean'",
                 name="accepted_values_clean"),
    ])


def _singular_failures(spark, d):
    """The warehouse's singular tests as failing-row queries: one pass over the staged rows, one over the shared totals."""
    keep = ["check_name", "station_complex_id", "detail"]
    totals = monthly_all(spark, d)
    eq = dq.failing_rows(equity(spark, d, totals=totals), "equity_risk_score < 0 OR equity_risk_score > 100", "equity_score_bounds")
    rc = dq.failing_rows(monthly(spark, d, totals), "data_quality_flag = 'clean' AND (monthly_recovery_pct < 0 OR monthly_recovery_pct > 200)",
                         "recovery_pct_bounds")
    rows = dq.failing_rules(stg_all(spark, d), {
        "ridership_not_negative": ("ridership < 0", "ridership"),
        "transit_year_valid": ("transit_year NOT IN (2022, 2023, 2024, 2025)", "transit_year"),
    })
    return (
        eq.select("check_name", "station_complex_id", F.col("equity_risk_score").cast("double").alias("detail"))
        .unionByName(rc.select("check_name", "station_complex_id", F.col("monthly_recovery_pct").cast("double").alias("detail")))
        .unionByName(rows.select(*keep))
    )


@register("dq_range")
def q_dq_range(spark, d):
    return _singular_failures(spark, d)


@register("orphan_keys")
def q_orphan_keys(spark, d):
    return dq.orphan_keys(stg_cur(spark, d), stg_base(spark, d), "station_complex_id")


@register("dq_report")
def q_dq_report(spark, d):
    totals = monthly_all(spark, d)  # shared by the recovery and scorecard checks
    sc = materialize(scorecard(spark, d, totals), "scorecard")  # read by the row rules and by the unique rule
    return dq.dq_report({
        "stg_ridership": (stg_all(spark, d, True), [
            dq.Check("not_null", "transit_timestamp"), dq.Check("not_null", "station_complex_id"),
            dq.Check("not_null", "ridership"), dq.Check("accepted_values", "borough", REFERENCE_BOROUGHS, severity="warn"),
            dq.Check("expression", "ridership", fails_when="ridership < 0", name="ridership_not_negative"),
        ]),
        "recovery_monthly": (monthly(spark, d, totals), [
            dq.Check("not_null", "station_complex_id"),
            dq.Check("accepted_values", "data_quality_flag", ("clean", "suspect_merged", "suspect_split", "no_baseline")),
            dq.Check("expression", "monthly_recovery_pct",
                     fails_when="data_quality_flag = 'clean' AND (monthly_recovery_pct < 0 OR monthly_recovery_pct > 200)",
                     name="recovery_pct_bounds"),
        ]),
        "recovery_scorecard": (sc, [
            dq.Check("accepted_values", "record_type", ("station", "borough")),
            dq.Check("not_null", "recovery_tier"),
            dq.Check("unique", ("record_type", "borough", "station_complex_id", "transit_year")),
        ]),
        "congestion_hourly": (cg.congestion_hourly(hub_coarse(spark, d)), [
            dq.Check("accepted_values", "hour_classification",
                     ("Peak Hour", "Near Peak", "AM Off Peak", "PM Off Peak", "Overnight")),
            dq.Check("accepted_values", "data_quality_flag", ("clean",), severity="warn"),
        ]),
    })


# ------------------------------------------------------------------ contracts
BRONZE_CONTRACT = (
    dq.ColumnContract("transit_timestamp", "timestamp_ntz", nullable=False),
    dq.ColumnContract("station_complex_id", "string", nullable=False),
    dq.ColumnContract("borough", "string", values=tuple(r.upper() for r in REFERENCE_BOROUGHS)),
    dq.ColumnContract("fare_class_category", "string", values=("A", "N", "R")),
    dq.ColumnContract("ridership", "double", nullable=False, min_value=0),
    dq.ColumnContract("latitude", "string"),
    dq.ColumnContract("station_status", "string"),
)


@register("contract_bronze")
def q_contract_bronze(spark, d):
    return dq.contract_bronze(B.ridership_monthly_raw(spark, d, with_defects=True), BRONZE_CONTRACT)


GATE_CONTRACT = (
    dq.ColumnContract("transit_timestamp", "timestamp_ntz", nullable=False),
    dq.ColumnContract("station_complex_id", "string", nullable=False),
    dq.ColumnContract("fare_class_category", "string", values=("A", "R")),
    dq.ColumnContract("ridership", "double", nullable=False, min_value=0),
)


@register("contract_rejects")
def q_contract_rejects(spark, d):
    _, rejects = dq.contract_gate(B.ridership_monthly_raw(spark, d, with_defects=True), GATE_CONTRACT)
    return rejects.select("transit_timestamp", "station_complex_id", "fare_class_category", "ridership", "reject_reason")


@register("contract_gold")
def q_contract_gold(spark, d):
    sc = scorecard(spark, d)
    return dq.contract_gold(sc, SCORECARD_SCHEMA)


SCORECARD_SCHEMA = T.StructType([T.StructField(n, getattr(T, t)()) for n, t in (
    ("record_type", "StringType"), ("transit_year", "LongType"), ("borough", "StringType"),
    ("station_complex_id", "StringType"), ("station_name", "StringType"), ("latitude", "DoubleType"),
    ("longitude", "DoubleType"), ("annual_ridership", "DoubleType"), ("annual_baseline_2019", "DoubleType"),
    ("recovery_pct", "DoubleType"), ("data_quality_flag", "StringType"), ("borough_avg_recovery_pct", "DoubleType"),
    ("recovery_tier", "StringType"), ("pct_vs_borough_avg", "DoubleType"),
)])


# ------------------------------------------------------------------ sources / sinks
@register("scan_bronze_csv")
def q_scan_bronze_csv(spark, d):
    raw = B.ridership_monthly_raw(spark, d)
    path = scratch_path(spark, "bronze-csv")
    strings = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    strings = strings.withColumn("year", F.year(F.col("transit_timestamp").cast("timestamp_ntz")))
    strings.write.mode("overwrite").option("header", True).partitionBy("year").csv(path)
    back = bronze.read_bronze(spark, path, bronze.string_schema(raw.columns))
    return stg.stg_ridership(back.drop("year"))


@register("time_slice")
def q_time_slice(spark, d):
    return bronze.time_slice(stg_coarse(spark, d, True), "transit_timestamp", "2024-01-08", "2024-01-15")


@register("land_partitioned")
def q_land_partitioned(spark, d):
    path = scratch_path(spark, "landed")
    bronze.land(B.hourly_coarse_raw(spark, d), path, "transit_timestamp")
    return bronze.read_landed(spark, path)


@register("quarter_bucket")
def q_quarter_bucket(spark, d):
    q = bronze.with_quarter(stg_all(spark, d), "transit_timestamp")
    return q.groupBy("transit_year", "quarter").agg(
        F.sum(F.col("ridership").cast("decimal(18,2)")).cast("double").alias("ridership"), F.count(F.lit(1)).alias("row_count")
    )


def _census_rows(spark, d):
    path = scratch_path(spark, "census-json")
    B.census_docs(spark, d).write.mode("overwrite").text(path)
    return census.rows_from_header_json(spark.read.text(path), "value", list(B.CENSUS_HEADER))


@register("census_rejects")
def q_census_rejects(spark, d):
    """Documents damaged in four ways (by tract number), as :func:`census.census_rejects` reports them."""
    n = F.regexp_extract("value", r'"(\d{6})"\]\]$', 1).cast("int") % 9
    bad = (
        F.when(n == 0, F.concat(F.lit("x"), F.col("value"))).when(n == 3, F.lit(" ")).when(n == 6, F.lit("[]"))
        .when(n == 1, F.regexp_replace("value", r'"tract"\]', '"tract","extra"]')).otherwise(F.col("value"))
    )
    r = census.census_rejects(B.census_docs(spark, d).select(bad.alias("value")))
    return r.groupBy("reject_reason", F.col("row").cast("bigint").alias("row")).agg(F.count(F.lit(1)).alias("n"))


@register("census_header_json")
def q_census_header_json(spark, d):
    return _census_rows(spark, d)


def _census_typed(spark, d):
    return census.coerce_numeric(census.rename_variables(_census_rows(spark, d)))


@register("coerce_numeric")
def q_coerce_numeric(spark, d):
    return _census_typed(spark, d)


@register("demographic_rates")
def q_demographic_rates(spark, d):
    return census.demographic_rates(_census_typed(spark, d))


@register("geoid_borough")
def q_geoid_borough(spark, d):
    return census.with_geoid(_census_typed(spark, d)).select("geoid", "borough", "county", "tract", "neighborhood_name")


@register("union_parts")
def q_union_parts(spark, d):
    return census.union_parts(stg_cur(spark, d, True).drop("transfers"), stg_coarse(spark, d, True))


@register("sample_head")
def q_sample_head(spark, d):
    return census.sample_head(stg.stg_census(B.census_raw(spark, d)), "geoid", 20)


@register("gold_roundtrip")
def q_gold_roundtrip(spark, d):
    path = scratch_path(spark, "gold-scorecard")
    bronze.write_gold(scorecard(spark, d), path, ["borough", "transit_year"], schema=SCORECARD_SCHEMA)
    return bronze.read_gold(spark, path)


@register("gold_zorder")
def q_gold_zorder(spark, d):
    """A gold table whose files follow three columns at once, read back."""
    path = scratch_path(spark, "gold-zorder")
    bronze.write_zorder(scorecard(spark, d), path, ["borough", "transit_year", "recovery_pct"], files=16)
    return bronze.read_gold(spark, path)


# ------------------------------------------------------------------ incremental / streaming
@register("incremental_upsert")
def q_incremental_upsert(spark, d):
    ev = B.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("event_date", F.to_date("ts"))
    path = scratch_path(spark, "upsert-target")
    ev.filter(F.col("event_id") % 2 == 0).write.partitionBy("event_date").parquet(path)
    changed = ev.filter(F.col("event_id") % 20 == 0).withColumn("value", F.col("value") + 1)
    fresh = ev.filter(F.col("event_id") % 2 == 1)
    dup = ev.filter(F.col("event_id") % 1000 == 1).withColumn("value", F.col("value") + 2)
    batch = changed.withColumn("_v", F.lit(1)).unionByName(fresh.withColumn("_v", F.lit(1))).unionByName(dup.withColumn("_v", F.lit(2)))
    inc.upsert_partitions(spark, path, batch, ["event_id"], "event_date", order=["_v"])
    return spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type", "value", "event_date")


@register("schema_sync")
def q_schema_sync(spark, d):
    raw = B.hourly_coarse_raw(spark, d)
    split = F.lit(B.SPLIT_DATE).cast("timestamp_ntz")
    old = raw.filter(F.col("transit_timestamp") < split).withColumn("legacy_flag", F.lit(True))
    new = raw.filter(F.col("transit_timestamp") >= split).drop("transfers").withColumn("ingest_batch", F.lit(2).cast("bigint"))
    return inc.schema_sync(old, new)


def _land_for_stream(df, ts, path, mode="append"):
    """Write ``df`` as stream input, in files that are ranges of event time."""
    df.repartitionByRange(ts).write.mode(mode).parquet(path)


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]


@register("upsert_moved_key")
def q_upsert_moved_key(spark, d):
    """Every tenth event moves to the next day: it must leave its old partition."""
    ev = B.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value").withColumn("event_date", F.to_date("ts"))
    path = scratch_path(spark, "moved-target")
    ev.write.partitionBy("event_date").parquet(path)
    moved = ev.filter(F.col("event_id") % 10 == 0).withColumn("event_date", F.date_add("event_date", 1)).withColumn("value", F.col("value") + 1)
    inc.upsert_partitions(spark, path, moved, ["event_id"], "event_date")
    return spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type", "value", "event_date")


@register("upsert_versions")
def q_upsert_versions(spark, d):
    """The table before and after a batch in which every tenth event moves to the next day and new events come."""
    ev = B.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value").withColumn("event_date", F.to_date("ts"))
    t = VersionedTable(spark, scratch_path(spark, "versions"), "event_date")
    t.upsert(ev.filter(F.col("event_id") % 7 != 3), ["event_id"])
    moved = ev.filter((F.col("event_id") % 10 == 0) & (F.col("event_id") % 7 != 3))
    moved = moved.withColumn("event_date", F.date_add("event_date", 1)).withColumn("value", F.col("value") + 1)
    t.upsert(moved.unionByName(ev.filter(F.col("event_id") % 7 == 3)), ["event_id"])
    states = [t.read(v).withColumn("version", F.lit(v).cast("bigint")) for v in t.versions()]
    return states[0].unionByName(states[1])


def _three_loads(rows, is_late, is_wrong):
    """Loads of a feed: a part with some wrong values, the rest, then the corrections."""
    wrong = rows.withColumn("ridership", F.when(is_wrong, F.col("ridership") * 2).otherwise(F.col("ridership")))
    return [wrong.filter(~is_late), rows.filter(is_late), rows.filter(~is_late & is_wrong)]


@register("marts_incremental")
def q_marts_incremental(spark, d):
    """Recovery after three loads, each of which brings only the changes to the marts."""
    facts, months, recovery = (VersionedTable(spark, scratch_path(spark, n), p) for n, p in (("facts", "month"), ("months", "bucket"), ("recovery", "bucket")))
    rows = materialize(live.consolidated(stg_all(spark, d)), "consolidated")
    is_wrong = F.col("station_complex_id").isin("3", "7", "20") & F.col("transit_month").isin(2, 6)
    for load in _three_loads(rows, F.col("transit_date") >= F.lit("2023-01-01"), is_wrong):
        facts.upsert(load, live.FACT_KEY)
        live.refresh_months(facts, months)
        live.refresh_recovery(months, recovery, baseline_year=B.BASELINE_YEAR)
    return recovery.read().drop("bucket")


@register("congestion_incremental")
def q_congestion_incremental(spark, d):
    """Hourly congestion after three loads, each of which works out the dates that it changes."""
    facts, mart = (VersionedTable(spark, scratch_path(spark, n), "transit_date") for n in ("hour-facts", "congestion"))
    rows = materialize(live.consolidated(stg_coarse(spark, d)).drop("month"), "consolidated")
    is_wrong = (F.col("transit_hour") == 8) & (F.dayofmonth("transit_date") % 5 == 0)
    for load in _three_loads(rows, F.col("transit_date") >= F.lit("2024-01-20"), is_wrong):
        facts.upsert(load, live.FACT_KEY)
        live.refresh_congestion(facts, mart, hours="distinct")
    return mart.read()


@register("stream_landing")
def q_stream_landing(spark, d):
    ev = B.table(spark, d, "events").select(*EVENT_COLS)
    src = scratch_path(spark, "stream-in")
    _land_for_stream(ev, "ts", src)
    return inc.stream_landing(spark, src, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt"), ev.schema)


def _dedup_runs(spark, d):
    """Two runs of one stream: all events, then repeats of some from the last and the first week."""
    ev = B.table(spark, d, "events").select(*EVENT_COLS)
    src, out, late, ckpt = (scratch_path(spark, f"dedup-{x}") for x in ("in", "out", "late", "ckpt"))
    _land_for_stream(ev, "ts", src)
    inc.stream_dedup(spark, src, out, late, ckpt, ev.schema, ["event_id"], "ts")
    last_week = F.col("ts") >= F.lit("2024-01-29").cast("timestamp_ntz")
    first_week = F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")
    _land_for_stream(ev.filter((F.col("event_id") % 50 == 0) & (last_week | first_week)), "ts", src)
    return inc.stream_dedup(spark, src, out, late, ckpt, ev.schema, ["event_id"], "ts"), late


@register("stream_dedup")
def q_stream_dedup(spark, d):
    return _dedup_runs(spark, d)[0]


@register("stream_dedup_late")
def q_stream_dedup_late(spark, d):
    return spark.read.parquet(_dedup_runs(spark, d)[1]).drop("batch_id")


def _hourly_input(spark, d):
    return stg_coarse(spark, d).select("station_complex_id", "transit_timestamp", "ridership")


@register("stream_hourly")
def q_stream_hourly(spark, d):
    s = _hourly_input(spark, d)
    src, out, late, ckpt = (scratch_path(spark, f"hourly-{x}") for x in ("in", "out", "late", "ckpt"))
    _land_for_stream(s, "transit_timestamp", src)
    return inc.stream_hourly(spark, src, out, late, ckpt, s.schema)


def _weeks_apart(spark, d):
    """The stream of :func:`_dedup_runs` by the stateful deduplication, several batches in each run."""
    ev = B.table(spark, d, "events").select(*EVENT_COLS)
    src, out, late, ckpt = (scratch_path(spark, f"state-{x}") for x in ("in", "out", "late", "ckpt"))
    last_week = F.col("ts") >= F.lit("2024-01-29").cast("timestamp_ntz")
    first_week = F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")
    for part in (ev, ev.filter((F.col("event_id") % 50 == 0) & (last_week | first_week))):
        _land_for_stream(part, "ts", src)
        done = stateful.stream_dedup_stateful(spark, src, out, late, ckpt, ev.schema, ["event_id"], "ts")
    return done, late


@register("stream_dedup_stateful")
def q_stream_dedup_stateful(spark, d):
    return _weeks_apart(spark, d)[0]


@register("stream_dedup_stateful_late")
def q_stream_dedup_stateful_late(spark, d):
    return spark.read.parquet(_weeks_apart(spark, d)[1]).drop("batch_id")


@register("stream_hourly_state")
def q_stream_hourly_state(spark, d):
    """The hub over three runs: rows of each come from all days of a stretch, by their minute."""
    s = _hourly_input(spark, d)
    src, out, late, ckpt = (scratch_path(spark, f"hours-{x}") for x in ("in", "out", "late", "ckpt"))
    day = F.to_date("transit_timestamp")
    split = F.lit(B.SPLIT_DATE).cast("date")
    odd = F.minute("transit_timestamp") % 2 == 1
    near = day >= F.date_sub(split, 5)  # within the delay of what came before
    for part in (s.filter((day < split) & ~(odd & near)), s.filter((day < split) & odd & near), s.filter(day >= split)):
        _land_for_stream(part, "transit_timestamp", src)
        hub = stateful.stream_hourly_state(spark, src, out, late, ckpt, s.schema)
    return hub


@register("stream_hourly_late")
def q_stream_hourly_late(spark, d):
    """Rows of even minutes come first; of the others, those far behind are late. All rows together are the batch hub."""
    s = _hourly_input(spark, d)
    src, out, late, ckpt = (scratch_path(spark, f"late-{x}") for x in ("in", "out", "late", "ckpt"))
    odd = F.minute("transit_timestamp") % 2 == 1
    for part in (s.filter(~odd), s.filter(odd)):
        _land_for_stream(part, "transit_timestamp", src)
        on_time = inc.stream_hourly(spark, src, out, late, ckpt, s.schema)
    behind = inc.hourly_sums(spark.read.schema(s.schema).parquet(late))
    both = on_time.withColumn("late_rows", F.lit(0).cast("bigint")).unionByName(behind.withColumn("late_rows", F.col("fare_rows")))
    return both.groupBy("station_complex_id", "transit_date", "transit_hour").agg(
        F.sum(F.col("hourly_ridership").cast("decimal(28,2)")).cast("double").alias("hourly_ridership"),
        F.sum("fare_rows").alias("fare_rows"), F.sum("late_rows").alias("late_rows"),
    )
