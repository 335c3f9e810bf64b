"""Dense 24-hour series per station-day and outage detection on them.

The source publishes a row only for hours with riders, so a missing hour is
a missing row. The spine is built without a join: the hub is grouped by
(station, date) into a map hour -> ridership (at most one entry per hour, so
the group is bounded by 24), then exploded over ``sequence(0, 23)``. The
output stays hash-partitioned by (station, date), so the rolling-zero window
and the daily rollup that follow add no shuffle. The station x hour profile
is computed from the sparse hub (days seen, active hours, sums) without the
spine and joined back as a stations x 24 dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import rnd, safe_div, season

HOURS = 24


def hour_spine(hub: DataFrame, hours: int = HOURS) -> DataFrame:
    """Every hour of every station-day, gaps as explicit zero rows (``is_gap_hour=1``)."""
    day = hub.groupBy("station_complex_id", "transit_date").agg(
        F.map_from_entries(F.collect_list(F.struct("transit_hour", "hourly_ridership"))).alias("_m")
    )
    dense = day.select(
        "station_complex_id", "transit_date", "_m", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("_h")
    )
    v = F.try_element_at(F.col("_m"), F.col("_h").cast("bigint"))
    return dense.select(
        "station_complex_id",
        "transit_date",
        F.col("_h").cast("bigint").alias("transit_hour"),
        F.coalesce(v, F.lit(0.0)).alias("hourly_ridership"),
        F.when(v.isNull(), 1).otherwise(0).alias("is_gap_hour"),
    )


def hour_profile(hub: DataFrame, hours: int = HOURS) -> DataFrame:
    """Historical profile per station x hour of day, from the sparse hub.

    ``days_observed`` = the station's distinct dates; average = sum / days;
    zero rate = (days - hours with riders) / days. An hour never seen at a
    station has average 0 and zero rate 1, as on the dense spine.
    """
    days = hub.groupBy("station_complex_id").agg(F.count_distinct("transit_date").alias("days_observed"))
    per_hour = hub.groupBy(F.col("station_complex_id").alias("_sid"), F.col("transit_hour").alias("_h")).agg(
        F.sum(F.col("hourly_ridership").cast("decimal(18,2)")).alias("_sum"),
        F.count_if(F.col("hourly_ridership") != 0).alias("_active"),
    )
    grid = days.select("station_complex_id", "days_observed", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("_hh"))
    grid = grid.withColumn("transit_hour", F.col("_hh").cast("bigint"))
    j = grid.join(
        per_hour, (grid.station_complex_id == per_hour._sid) & (grid.transit_hour == per_hour._h), "left"
    )
    total = F.coalesce(F.col("_sum").cast("double"), F.lit(0.0))
    zeros = F.col("days_observed") - F.coalesce(F.col("_active"), F.lit(0))
    return j.select(
        "station_complex_id",
        "transit_hour",
        safe_div(total, F.col("days_observed")).alias("historical_avg_this_hour"),
        rnd(safe_div(zeros, F.col("days_observed")), 4).alias("historical_zero_rate"),
        F.col("days_observed").cast("bigint").alias("days_observed"),
    )


def rolling_zero_count(dense: DataFrame, n: int = 3) -> DataFrame:
    """Zero hours among the current and ``n-1`` preceding hours of the station-day."""
    w = Window.partitionBy("station_complex_id", "transit_date").orderBy("transit_hour").rowsBetween(-(n - 1), 0)
    return dense.withColumn("consecutive_zero_count", F.count_if(F.col("hourly_ridership") == 0).over(w))


def zero_streaks(dense: DataFrame) -> DataFrame:
    """True length of the zero run ending at each hour (0 on active hours).

    Gaps-and-islands: a running count of active hours numbers the islands;
    within an island, zeros are counted cumulatively.
    """
    base = Window.partitionBy("station_complex_id", "transit_date").orderBy("transit_hour")
    island = F.sum(F.when(F.col("hourly_ridership") > 0, 1).otherwise(0)).over(
        base.rowsBetween(Window.unboundedPreceding, 0)
    )
    d = dense.withColumn("_island", island)
    w2 = Window.partitionBy("station_complex_id", "transit_date", "_island").orderBy("transit_hour").rowsBetween(
        Window.unboundedPreceding, 0
    )
    streak = F.when(F.col("hourly_ridership") == 0, F.count_if(F.col("hourly_ridership") == 0).over(w2)).otherwise(0)
    return d.select(
        "station_complex_id", "transit_date", "transit_hour", "hourly_ridership", streak.cast("bigint").alias("zero_streak")
    )


def outage_episodes(dense: DataFrame) -> DataFrame:
    """Every run of hours without riders, over day borders: station, first and last hour, number of hours.

    Islands are stitched on three levels, so a station's history is never one
    window: a day's runs come from its own 24 hours, runs that touch a day's
    border are joined within the month, and what touches a month's border is
    joined over the station's months (two runs for each at most). A day that
    is not in the input breaks a run: nothing is known about it.
    """
    station = "station_complex_id"
    day = F.datediff("transit_date", F.lit("1970-01-01").cast("date")).cast("bigint")
    zeros = F.collect_list(F.when(F.col("hourly_ridership") == 0, F.col("transit_hour")))
    days = dense.groupBy(station, "transit_date").agg(F.array_sort(zeros).alias("_z"))
    first = F.filter("_z", lambda h: ~F.array_contains("_z", h - 1))
    last = F.filter("_z", lambda h: ~F.array_contains("_z", h + 1))
    runs = F.transform(F.arrays_zip(first.alias("a"), last.alias("b")), lambda r: F.struct((day * HOURS + r["a"]).alias("a"), (day * HOURS + r["b"]).alias("b")))
    month = F.trunc("transit_date", "month")
    to_hours = lambda d: F.datediff(d, F.lit("1970-01-01").cast("date")).cast("bigint") * HOURS
    rows = days.select(station, month.alias("_month"), F.explode(runs).alias("r")).select(station, "_month", F.col("r.a").alias("_a"), F.col("r.b").alias("_b"))
    rows = rows.withColumn("_open", (F.col("_a") % HOURS == 0) | (F.col("_b") % HOURS == HOURS - 1))
    by_month = _joined_runs(rows.filter("_open"), [station, "_month"])
    starts, ends = to_hours(F.col("_month")), to_hours(F.add_months("_month", 1)) - 1
    by_month = by_month.withColumn("_open", (F.col("_a") == starts) | (F.col("_b") == ends))
    whole = _joined_runs(by_month.filter("_open"), [station])
    columns = [station, "_a", "_b"]
    done = rows.filter("NOT _open").select(*columns).unionAll(by_month.filter("NOT _open").select(*columns)).unionAll(whole.select(*columns))
    at = lambda c: F.date_from_unix_date(F.floor(F.col(c) / HOURS).cast("int"))
    return done.select(
        station, at("_a").alias("start_date"), F.pmod("_a", F.lit(HOURS)).alias("start_hour"), at("_b").alias("end_date"), F.pmod("_b", F.lit(HOURS)).alias("end_hour"),
        (F.col("_b") - F.col("_a") + 1).alias("outage_hours"),
    )


def _joined_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs (_a, _b) of a key, with those that follow on each other joined."""
    w = Window.partitionBy(*keys).orderBy("_a")
    follows = F.col("_a") == F.lag("_b").over(w) + 1
    island = runs.withColumn("_new", F.when(follows, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(w))
    return island.groupBy(*keys, "_island").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b")).drop("_island")


def utilization_status(
    dense: DataFrame,
    profile: DataFrame,
    quiet: tuple[int, int] = (0, 4),
    zero_rate: float = 0.5,
    min_avg: float = 50,
    min_zeros: int = 2,
    window: int = 3,
) -> DataFrame:
    """Five-way status of each station-hour (Active / Expected Low / Possible Disruption / Anomalous Zero)."""
    d = rolling_zero_count(dense, window)
    p = profile.select(
        F.col("station_complex_id").alias("_sid"),
        F.col("transit_hour").alias("_h"),
        "historical_avg_this_hour",
        "historical_zero_rate",
        "days_observed",
    )
    j = d.join(p, (d.station_complex_id == p._sid) & (d.transit_hour == p._h), "left").drop("_sid", "_h")
    r = F.col("hourly_ridership")
    zero = r == 0
    status = (
        F.when(r > 0, "Active")
        .when(zero & F.col("transit_hour").between(*quiet), "Expected Low")
        .when(zero & (F.col("historical_zero_rate") >= zero_rate), "Expected Low")
        .when(zero & (F.col("historical_avg_this_hour") > min_avg) & (F.col("consecutive_zero_count") >= min_zeros), "Possible Disruption")
        .when(zero & (F.col("historical_avg_this_hour") > min_avg), "Anomalous Zero")
        .otherwise("Expected Low")
    )
    return j.withColumn("utilization_status", status)


def utilization_daily(status: DataFrame, stations: DataFrame, am=(5, 12), pm=(13, 20)) -> DataFrame:
    """Roll the hourly status up to station x day (same partitioning: no shuffle)."""
    r = F.col("hourly_ridership")
    active = r > 0
    st = F.col("utilization_status")
    g = status.groupBy("station_complex_id", "transit_date").agg(
        F.count_if(active).alias("active_hours"),
        F.count_if(F.col("is_gap_hour") == 1).alias("gap_hours"),
        F.sum(r.cast("decimal(18,2)")).alias("_sum"),
        F.count_if(F.col("transit_hour").between(*am) & active).alias("am_active_hours"),
        F.count_if(F.col("transit_hour").between(*pm) & active).alias("pm_active_hours"),
        F.count_if(st == "Possible Disruption").alias("disruption_hours"),
        F.count_if(st == "Anomalous Zero").alias("anomalous_zero_hours"),
        F.count_if(st == "Expected Low").alias("expected_low_hours"),
        F.max("consecutive_zero_count").alias("max_consecutive_zeros"),
    )
    names = stations.select(F.col("station_complex_id").alias("_sid"), "station_name", "borough", "latitude", "longitude")
    g = g.join(names, g.station_complex_id == names._sid, "left")
    return g.select(
        "station_complex_id",
        "station_name",
        "borough",
        "latitude",
        "longitude",
        "transit_date",
        F.year("transit_date").cast("bigint").alias("ridership_year"),
        season(F.month("transit_date")).alias("season"),
        "active_hours",
        "gap_hours",
        rnd(safe_div("active_hours", F.lit(24)), 3).alias("utilization_rate"),
        rnd(safe_div(F.col("_sum"), F.col("active_hours")), 2).alias("demand_intensity"),
        "am_active_hours",
        "pm_active_hours",
        "disruption_hours",
        "anomalous_zero_hours",
        "expected_low_hours",
        "max_consecutive_zeros",
        F.col("_sum").cast("double").alias("daily_ridership"),
    )


def utilization_annual(daily: DataFrame) -> DataFrame:
    """Station x year: mean demand intensity and disruptions per 1,000 active hours."""
    g = daily.groupBy("station_complex_id", F.col("ridership_year").alias("transit_year")).agg(
        F.sum(F.col("demand_intensity").cast("decimal(18,2)")).alias("_di"),
        F.count("demand_intensity").alias("_ndi"),
        F.sum("disruption_hours").alias("_dis"),
        F.sum("active_hours").alias("_act"),
    )
    return g.select(
        "station_complex_id",
        "transit_year",
        rnd(safe_div("_di", "_ndi"), 1).alias("avg_demand_intensity"),
        rnd(safe_div(F.col("_dis") * 1000, F.col("_act")), 2).alias("disruption_rate_per_1k_hours"),
    )
