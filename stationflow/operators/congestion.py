"""Hourly congestion: the station-hour hub aggregate and everything built on it.

The hub (:func:`fare_consolidated`) collapses fare-class rows into one row per
station x date x hour with map-side partial aggregation; it is the largest
reduction in the chain and every congestion / utilisation operator reads it
instead of the raw rows. Downstream, the station-day windows share one
``(station, date)`` partitioning, and the (date, hour) system profile and the
capacity table are dimension-sized sides that Spark broadcasts only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import initcap_words
from stationflow.functions import dec_avg, dec_sum, hour_bucket, rnd, safe_div, season, tier
from stationflow.operators.common import exact_quantiles, join_same, rollup_with_attrs

INTENSITY_TIERS = ((15.0, "High Congestion"), (8.0, "Moderate"), (2.0, "Baseline"))
STRESS_TIERS = ((0.90, "At Capacity"), (0.70, "High Stress"), (0.50, "Moderate Stress"))


def fare_consolidated(stg: DataFrame) -> DataFrame:
    """Hub aggregate: ridership per station x date x hour, plus the fare-row count.

    The output is hash-partitioned by (station, date), which the station-day
    windows (day totals, peak rank) and the 24-hour spine reuse without a
    further shuffle.
    """
    g = rollup_with_attrs(
        stg,
        keys=["station_complex_id", "transit_date", "transit_hour"],
        attrs=["station_name", "borough"],
        sums={"_r": ("ridership", 18, 2), "_lat": ("latitude", 12, 6), "_lon": ("longitude", 12, 6)},
        counts={"fare_rows": "ridership", "_nlat": "latitude", "_nlon": "longitude"},
        attr_fn=initcap_words,
        partition_by=["station_complex_id", "transit_date"],
    )
    return g.select(
        "station_complex_id",
        "station_name",
        "borough",
        rnd(safe_div("_lat", "_nlat"), 6).alias("latitude"),
        rnd(safe_div("_lon", "_nlon"), 6).alias("longitude"),
        "transit_date",
        "transit_hour",
        F.dayofweek("transit_date").cast("bigint").alias("day_of_week"),
        F.col("_r").cast("double").alias("hourly_ridership"),
        F.col("fare_rows").cast("bigint").alias("fare_rows"),
    )


def station_dim(hub: DataFrame) -> DataFrame:
    """One row per station: max name / borough and mean coordinates."""
    g = rollup_with_attrs(
        hub,
        keys=["station_complex_id"],
        attrs=["station_name", "borough"],
        sums={"_lat": ("latitude", 12, 6), "_lon": ("longitude", 12, 6)},
        counts={"_nlat": "latitude", "_nlon": "longitude"},
        attr_fn=initcap_words,
    )
    return g.select(
        "station_complex_id",
        "station_name",
        "borough",
        rnd(safe_div("_lat", "_nlat"), 6).alias("latitude"),
        rnd(safe_div("_lon", "_nlon"), 6).alias("longitude"),
    )


def system_hourly(hub: DataFrame) -> DataFrame:
    """System-wide ridership and active stations per date x hour.

    The hub has one row per station-hour, so ``count`` equals
    ``count(distinct station)`` without the distinct-aggregate rewrite.
    """
    return hub.groupBy("transit_date", "transit_hour").agg(
        dec_sum("hourly_ridership").alias("system_total_ridership"),
        F.count(F.lit(1)).alias("active_stations"),
    )


BITMAP_SPREAD = 64


def station_numbers(hub: DataFrame) -> DataFrame:
    """(station, number): a number of its own for each station, from its place among those of the same hash part.

    The parts are numbered side by side, so no task holds all stations.
    """
    part = F.pmod(F.xxhash64("station_complex_id"), F.lit(BITMAP_SPREAD))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("station_complex_id")) - 1
    ids = hub.select("station_complex_id").filter(F.col("station_complex_id").isNotNull()).distinct().withColumn("_part", part)
    return ids.select("station_complex_id", (place.cast("bigint") * BITMAP_SPREAD + F.col("_part")).alias("number"))


def station_bitmaps(hub: DataFrame, numbers: DataFrame) -> DataFrame:
    """The stations of each date and hour as bitmaps of their numbers (one row for each 32,768 numbers in use).

    Kept as a table, it answers distinct counts of any coarser grain by uniting
    bitmaps: the rows are not read again.
    """
    n = numbers.select(F.col("station_complex_id").alias("_s"), "number")
    rows = hub.select("station_complex_id", "transit_date", "transit_hour").join(n, F.col("station_complex_id") == F.col("_s"))
    number = F.col("number") + 1  # Spark's bitmap positions count from 1
    return rows.groupBy("transit_date", "transit_hour", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("stations")
    )


def united(bitmaps: DataFrame, grain: list) -> DataFrame:
    """Bitmaps united to a coarser grain (columns), still mergeable."""
    return bitmaps.groupBy(*grain, "bucket").agg(F.bitmap_or_agg("stations").alias("stations"))


def active_stations_rollup(bitmaps: DataFrame) -> DataFrame:
    """Distinct stations of each hour, day and month and of all time: (grain, period_start, transit_hour, active_stations).

    Each grain is united from the one below it.
    """
    day = united(bitmaps, ["transit_date"])
    month = united(day, [F.trunc("transit_date", "month").alias("transit_date")])
    whole = united(month, [])
    none_hour, none_date = F.lit(None).cast("bigint").alias("transit_hour"), F.lit(None).cast("date").alias("period_start")
    count = F.sum(F.bitmap_count("stations")).alias("active_stations")
    start = F.col("transit_date").alias("period_start")
    out = bitmaps.groupBy("transit_date", "transit_hour").agg(count).select(F.lit("hour").alias("grain"), start, "transit_hour", "active_stations")
    for name, rows in (("day", day), ("month", month)):
        out = out.unionAll(rows.groupBy("transit_date").agg(count).select(F.lit(name), start, none_hour, "active_stations"))
    return out.unionAll(whole.groupBy().agg(F.coalesce(count, F.lit(0)).alias("active_stations")).select(F.lit("all"), none_date, none_hour, "active_stations"))


def _day_window():
    return Window.partitionBy("station_complex_id", "transit_date")


def peak_rank(hub: DataFrame) -> DataFrame:
    """Dense rank of each hour within its station-day, busiest first (ties share)."""
    w = _day_window().orderBy(F.col("hourly_ridership").desc())
    return hub.select(
        "station_complex_id",
        "transit_date",
        "transit_hour",
        "hourly_ridership",
        F.dense_rank().over(w).cast("bigint").alias("daily_peak_rank"),
    )


def congestion_hourly(
    hub: DataFrame,
    hours: str = "rows",
    suspect_high: float = 5000,
    am: tuple[int, int] = (5, 12),
    pm: tuple[int, int] = (13, 20),
) -> DataFrame:
    """Station-hour congestion vs the station's own day and vs the system.

    ``hours='rows'`` divides the day total by the number of fare rows (the
    warehouse model's ``count(*)``); ``'distinct'`` by the hours reported.
    Day totals and the dense rank are windows over (station, date), the
    partitioning the hub already has (no shuffle); the system profile is a
    window over (date, hour) on the same rows (one shuffle of the hub, whose
    partitions hold at most one row per station). No join, one scan.
    """
    w = _day_window()
    day_total = F.sum(F.col("hourly_ridership").cast("decimal(18,2)")).over(w)
    n_hours = F.sum("fare_rows").over(w) if hours == "rows" else F.count(F.lit(1)).over(w)
    rank = F.dense_rank().over(w.orderBy(F.col("hourly_ridership").desc()))
    scored = hub.select("*", day_total.alias("_day"), n_hours.alias("_hours"), rank.alias("_rank"))
    ws = Window.partitionBy("transit_date", "transit_hour")
    j = scored.select(
        "*",
        F.sum(F.col("hourly_ridership").cast("decimal(18,2)")).over(ws).alias("system_total_ridership"),
        F.count(F.lit(1)).over(ws).alias("active_stations"),
    )
    r = F.col("hourly_ridership")
    hc = (
        F.when(F.col("_rank") == 1, "Peak Hour")
        .when(F.col("_rank") <= 3, "Near Peak")
        .when(F.col("transit_hour").between(*am), "AM Off Peak")
        .when(F.col("transit_hour").between(*pm), "PM Off Peak")
        .otherwise("Overnight")
    )
    return j.select(
        "station_complex_id",
        "station_name",
        "borough",
        "latitude",
        "longitude",
        "transit_date",
        "transit_hour",
        "day_of_week",
        F.year("transit_date").cast("bigint").alias("ridership_year"),
        season(F.month("transit_date")).alias("season"),
        "hourly_ridership",
        rnd(safe_div(r, safe_div(F.col("_day"), F.nullif(F.col("_hours"), F.lit(0)))), 3).alias("station_congestion_index"),
        rnd(safe_div(r, safe_div("system_total_ridership", F.nullif(F.col("active_stations"), F.lit(0)))), 3).alias(
            "system_contribution_index"
        ),
        F.when(r > suspect_high, "suspect_high").when(r < 0, "suspect_negative").otherwise("clean").alias("data_quality_flag"),
        hc.alias("hour_classification"),
        F.when(F.col("_rank") == 1, F.col("transit_hour")).alias("station_peak_hour"),
    )


def capacity_p95(base: DataFrame, q: float = 0.95, consolidate: bool = True, baseline_year: int = 2019) -> DataFrame:
    """Baseline capacity per station x time bucket: max and p95 (rounded to 0 dp).

    ``base`` is staged baseline rows. ``consolidate=True`` takes the
    percentile over station-hours (fare classes summed first);
    ``False`` over raw fare rows as the warehouse model does. Percentiles are
    exact and hold no group's rows in one buffer (:func:`exact_quantiles`).
    """
    if consolidate:
        src = fare_consolidated(base).select("station_complex_id", "transit_hour", "hourly_ridership")
    else:
        src = base.select("station_complex_id", "transit_hour", F.col("ridership").alias("hourly_ridership"))
    src = src.withColumn("time_bucket", hour_bucket("transit_hour"))
    g = exact_quantiles(src, ["station_complex_id", "time_bucket"], "hourly_ridership", [q])
    return g.select(
        "station_complex_id", "time_bucket", F.col("max_value").alias(f"max_{baseline_year}_ridership"), rnd(F.col("q0"), 0).alias("p95_capacity_proxy")
    )


def top_value_per_group(df: DataFrame, group: list[str], col: str, out: str = "top_value", approx: bool = False) -> DataFrame:
    """Most frequent non-NULL value per group; ties go to the smallest value.

    Built on Spark's ``mode`` aggregate (a per-group value -> count map with
    partial aggregation), deterministic tie-break. ``approx=True`` keeps a
    bounded sketch per group instead (``approx_top_k``), for columns with very
    many values.
    """
    if approx:
        return df.groupBy(*group).agg(F.expr(f"get(approx_top_k({col}, 1), 0).item").alias(out))
    return df.groupBy(*group).agg(F.mode(col, True).alias(out))


def lower_median(col: str) -> F.Column:
    """Exact lower median (``percentile_disc(0.5)``)."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {col})")


def congestion_mart(
    hourly: DataFrame,
    capacity: DataFrame,
    stations: DataFrame,
    intensity=INTENSITY_TIERS,
    stress=STRESS_TIERS,
    approx_median: bool = False,
) -> DataFrame:
    """Station x year x season x weekday x hour class rollup of the hourly table.

    Capacity joins on (station, time bucket of the hour), so each hourly row
    meets exactly one ceiling; the group's ceiling is the largest it met.
    Station names come from the station dimension (a small join) so the
    aggregate stays hash/object-hash based.
    """
    cap = capacity.select(F.col("station_complex_id").alias("_cid"), F.col("time_bucket").alias("_tb"), "p95_capacity_proxy")
    h = hourly.withColumn("_tb_h", hour_bucket("transit_hour"))
    j = h.join(cap, (h.station_complex_id == cap._cid) & (h._tb_h == cap._tb), "left")
    median = F.percentile_approx("hourly_ridership", 0.5, 10000) if approx_median else lower_median("hourly_ridership")
    avg_r = dec_avg("hourly_ridership")
    g = j.groupBy(
        "station_complex_id",
        "borough",
        "ridership_year",
        "season",
        "day_of_week",
        F.col("hour_classification").alias("time_period"),
    ).agg(
        rnd(dec_avg("latitude", 12, 6), 6).alias("latitude"),
        rnd(dec_avg("longitude", 12, 6), 6).alias("longitude"),
        F.max("p95_capacity_proxy").alias("p95_capacity_ceiling"),
        F.count(F.lit(1)).alias("observation_count"),
        rnd(avg_r, 1).alias("avg_hourly_ridership"),
        median.alias("median_hourly_ridership"),
        rnd(dec_avg("station_congestion_index", 18, 3), 3).alias("avg_congestion_index"),
        rnd(safe_div(avg_r, F.max("p95_capacity_proxy")), 3).alias("throughput_stress_index"),
        F.mode("station_peak_hour", True).alias("most_common_peak_hour"),
    )
    names = stations.select(F.col("station_complex_id").alias("_sid"), "station_name")
    g = g.join(names, g.station_complex_id == names._sid, "left").drop("_sid")
    return g.select(
        "*",
        tier("avg_congestion_index", intensity, "Off Peak").alias("congestion_intensity_tier"),
        tier("throughput_stress_index", stress, "Low Stress").alias("throughput_stress_tier"),
    )


def station_thresholds(hub: DataFrame, q: float = 0.95) -> DataFrame:
    """Per-station alert threshold from its own hourly distribution.

    Each station-hour gets its station's q-quantile and whether it exceeds it.
    The quantiles are a station-sized table, joined back; no task holds a
    station's whole history.
    """
    thr = exact_quantiles(hub, ["station_complex_id"], "hourly_ridership", [q])
    thr = thr.select(F.col("station_complex_id").alias("_sid"), rnd(F.col("q0"), 2).alias("station_threshold"))
    rows = hub.select("station_complex_id", "transit_date", "transit_hour", "hourly_ridership")
    rows = rows.join(thr, F.col("station_complex_id").eqNullSafe(F.col("_sid")), "left").drop("_sid")
    return rows.withColumn("above_threshold", F.col("hourly_ridership") > F.col("station_threshold"))


def station_hour_thresholds(hub: DataFrame, k: float = 3.0, digits: int = 4) -> DataFrame:
    """Alert thresholds for each hour of the week of each station: median plus ``k`` robust deviations.

    Two passes over counted values (:func:`exact_quantiles`): the median, then
    the median distance from it (times 1.4826, the deviation of a normal
    distribution). No task holds a station's values.
    """
    keys = ["station_complex_id", "day_of_week", "transit_hour"]
    rows = hub.select(*keys, "hourly_ridership")
    middle = exact_quantiles(rows, keys, "hourly_ridership", [0.5]).select(*keys, "n", F.col("q0").alias("median_ridership"))
    away = join_same(rows, middle, keys).select(*keys, F.abs(F.col("hourly_ridership") - F.col("median_ridership")).alias("_away"))
    spread = exact_quantiles(away, keys, "_away", [0.5]).select(*keys, F.col("q0").alias("_mad"))
    out = join_same(middle, spread, keys)
    return out.select(
        *keys, "n", rnd(F.col("median_ridership"), digits).alias("median_ridership"), rnd(F.col("_mad"), digits).alias("median_deviation"),
        rnd(F.col("median_ridership") + F.lit(k) * F.lit(1.4826) * F.col("_mad"), digits).alias("threshold"),
    )
