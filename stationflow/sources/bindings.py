"""Bindings: canonical operator inputs derived from the shared test tables.

The library's operators expect bronze ridership rows, census tract rows,
meter readings and tract cells. The test warehouse holds TPC-H-style tables
and an event stream, so each binding below re-keys those tables into one
canonical input. The same definitions are written as SQL CTEs in
``stationflow.plans.oracle`` so the DuckDB oracle sees identical inputs.
Every binding is a plain projection/join over the full tables, so its work
grows with the data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the bindings (shared verbatim with the oracle SQL).
N_STATIONS_MONTHLY = 20
DATE_SHIFT_MONTHS = 288  # 1995 -> 2019 baseline, 1998-2000 -> 2022-2024
BASELINE_YEAR = 2019
NO_BASELINE_STATION = 13  # its baseline rows belong to the station below, which has no others
BASELINE_ONLY_STATION = 20
EVENT_TYPE_REGION = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}
SPLIT_DATE = "2024-01-16"  # B4: baseline half is before this date


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_sources(spark: SparkSession, sf_dir: str, names=("region", "nation", "customer", "lineitem", "events")) -> dict:
    """Named source binding: one temp view per Parquet table (nothing but the schemas is read)."""
    views = {}
    for n in names:
        df = table(spark, sf_dir, n)
        df.createOrReplaceTempView(n)
        views[n] = df
    return views


def _region(spark, sf_dir):
    return table(spark, sf_dir, "region").select("r_regionkey", "r_name")


def _dbl(c):
    return c.cast("double")


def ridership_monthly_raw(spark: SparkSession, sf_dir: str, with_defects: bool = False) -> DataFrame:
    """B1: multi-year bronze ridership from ``lineitem`` (baseline 2019, every other year current)."""
    li = table(spark, sf_dir, "lineitem")
    k = ((F.col("l_orderkey") + F.col("l_linenumber")) % N_STATIONS_MONTHLY).cast("bigint")
    ts = F.col("l_shipdate") + F.make_ym_interval(F.lit(0), F.lit(DATE_SHIFT_MONTHS))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")  # prices carry 2 decimals
    base = li.select(
        k.alias("k"),
        ts.alias("transit_timestamp"),
        cents.alias("cents"),
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
        "l_linenumber",
        "l_discount",
    ).withColumn("yr", F.year("transit_timestamp"))
    moved = (F.col("yr") == BASELINE_YEAR) & (F.col("k") == NO_BASELINE_STATION)
    base = base.withColumn("k", F.when(moved, F.lit(BASELINE_ONLY_STATION).cast("bigint")).otherwise(F.col("k")))
    reg = _region(spark, sf_dir)
    joined = base.join(reg, (base.k % 5) == reg.r_regionkey, "left")
    # price * factor, as exact integer cents / 100 (the correctly rounded double of the decimal product)
    factor = F.when(F.col("yr") == BASELINE_YEAR, F.lit(100)).otherwise(F.lit(20) + F.lit(10) * F.col("k"))
    ridership = _dbl(F.col("cents") * factor) / F.lit(100.0)
    station_id = F.col("k").cast("string")
    if with_defects:
        ridership = (
            F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
            .when(F.col("l_quantity") == 1, -ridership)
            .otherwise(ridership)
        )
        station_id = F.when(F.col("l_discount") == 0.1, F.lit(None).cast("string")).otherwise(station_id)
    return joined.select(
        F.col("transit_timestamp"),
        station_id.alias("station_complex_id"),
        F.concat(
            F.col("k").cast("string"), F.lit("-"), (F.col("k") + 1).cast("string"),
            F.lit(" "), F.lower("r_name"), F.lit(" st (a,b)"),
        ).alias("station_complex"),
        F.col("r_name").alias("borough"),
        (_dbl(F.lit(4050) + F.col("k")) / F.lit(100.0).cast("double")).alias("latitude"),
        (_dbl(F.lit(-7410) + (F.col("k") % 5) * 2) / F.lit(100.0).cast("double")).alias("longitude"),
        F.lit("SUBWAY").alias("transit_mode"),
        F.when(F.col("l_linestatus") == "O", "OMNY").otherwise("MetroCard").alias("payment_method"),
        F.col("l_returnflag").alias("fare_class_category"),
        ridership.alias("ridership"),
        _dbl(F.col("l_quantity")).alias("transfers"),
    )


def _events_raw(spark, sf_dir, station: F.Column, fare_class: F.Column, region_key: F.Column) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    ev = ev.select(
        F.col("ts"),
        station.alias("k"),
        fare_class.alias("fare_class_category"),
        region_key.alias("rk"),
        F.col("value"),
    )
    reg = _region(spark, sf_dir)
    j = ev.join(reg, ev.rk == reg.r_regionkey, "left")
    return j.select(
        F.col("ts").alias("transit_timestamp"),
        F.col("k").alias("station_complex_id"),
        F.concat(F.col("k"), F.lit(" station (q.r)")).alias("station_complex"),
        F.col("r_name").alias("borough"),
        (_dbl(F.lit(4060) + F.col("rk")) / F.lit(100.0).cast("double")).alias("latitude"),
        (_dbl(F.lit(-7390) - F.col("rk")) / F.lit(100.0).cast("double")).alias("longitude"),
        F.lit("subway").alias("transit_mode"),
        F.lit("omny").alias("payment_method"),
        F.col("fare_class_category"),
        _dbl(F.col("value")).alias("ridership"),
        F.lit(0.0).alias("transfers"),
    )


def _event_region():
    expr = None
    for name, key in EVENT_TYPE_REGION.items():
        expr = F.when(F.col("event_type") == name, key) if expr is None else expr.when(F.col("event_type") == name, key)
    return expr.otherwise(0)


def hourly_coarse_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: five busy stations (one per event type), fare class = user % 3."""
    return _events_raw(
        spark, sf_dir,
        station=F.col("event_type"),
        fare_class=(F.col("user_id") % 3).cast("string"),
        region_key=_event_region(),
    )


def hourly_fine_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3: twenty sparse stations (user % 20), fare class = event type."""
    k = (F.col("user_id") % 20)
    return _events_raw(
        spark, sf_dir,
        station=k.cast("string"),
        fare_class=F.col("event_type"),
        region_key=(k % 5).cast("int"),
    )


def meter_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5: one cumulative meter per user.

    The counter is the number of 10-minute ticks since 2024-01-01, wrapping
    at 1000 (about every 7 days), so readings show first rows, resets and
    large jumps. Row-local: no window over the raw events.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    ticks = (
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint") * 144
        + F.hour("ts").cast("bigint") * 6
        + F.floor(F.minute("ts") / 10).cast("bigint")
    )
    desc = F.when(F.col("event_id") % 17 == 0, "RECOVR AUD").otherwise("REGULAR")
    return ev.select(
        (F.col("user_id") % 10).cast("string").alias("c_a"),
        (F.col("user_id") % 100).cast("string").alias("unit"),
        F.col("user_id").cast("string").alias("scp"),
        F.concat(F.lit("S"), (F.col("user_id") % 20).cast("string")).alias("station"),
        F.lit("ace").alias("line_name"),
        F.lit("ind").alias("division"),
        F.to_date("ts").alias("date"),
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("time"),
        desc.alias("description"),
        (ticks % 1000).alias("entries"),
        ((ticks * 3) % 1000).alias("exits"),
    )


# ---------------------------------------------------------------- geo (B6)
GEO_CELL_M = 100.0
GEO_RADIUS_CELLS = 8
GEO_GRID = 50
GEO_TRACT_CELLS = 10
GEO_LAT0, GEO_LON0 = 40.5, -74.1


def station_entrances(stations: DataFrame) -> DataFrame:
    """Entrances of the stations in local metres (one row per entrance).

    ``stations`` is a station dimension (one row per id, derived from the
    ridership rows); entrances ``e = 0..k%3`` sit at lattice cell
    ``((7k+3e) % 50, (13k+5e) % 50)``.
    """
    k = F.col("station_complex_id").cast("bigint")
    ent = stations.select("station_complex_id").withColumn("e", F.explode(F.sequence(F.lit(0), (k % 3).cast("int"))))
    kk = F.col("station_complex_id").cast("bigint")
    return ent.select(
        "station_complex_id",
        F.col("e").cast("bigint").alias("entrance"),
        (((kk * 7 + F.col("e") * 3) % GEO_GRID).cast("double") * GEO_CELL_M).alias("x"),
        (((kk * 13 + F.col("e") * 5) % GEO_GRID).cast("double") * GEO_CELL_M).alias("y"),
    )


def tract_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracts as axis-aligned squares: nation n covers a 10x10-cell block."""
    nat = table(spark, sf_dir, "nation").select("n_nationkey")
    n = F.col("n_nationkey").cast("bigint")
    side = GEO_TRACT_CELLS * GEO_CELL_M
    return nat.select(
        F.format_string("36%03d%06d", F.lit(5), n).alias("geo_id"),
        F.concat(F.lit("Tract "), n.cast("string")).alias("tract_name"),
        F.lit("36").alias("state_fips_code"),
        F.lit("005").alias("county_fips_code"),
        ((n % 5).cast("double") * side).alias("xmin"),
        (F.floor(n / 5).cast("double") * side).alias("ymin"),
        ((n % 5 + 1).cast("double") * side).alias("xmax"),
        (F.floor(n / 5).cast("double") * side + side).alias("ymax"),
    )


def tract_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracts as shapes with holes: each square without a rhombus around its middle, in which a small square belongs to it again."""
    from stationflow.operators.geometry import part

    mx, my = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    ring = lambda *points: F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])
    outer = ring((F.col("xmin"), F.col("ymin")), (F.col("xmax"), F.col("ymin")), (F.col("xmax"), F.col("ymax")), (F.col("xmin"), F.col("ymax")))
    hole = ring((mx - 250, my), (mx, my - 300), (mx + 250, my), (mx, my + 300))
    island = ring((mx - 60, my - 60), (mx - 60, my + 60), (mx + 60, my + 60), (mx + 60, my - 60))
    parts = F.array(part(outer), part(hole, hole=True), part(island))
    return tract_rectangles(spark, sf_dir).select("geo_id", parts.alias("parts"))


def census_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 demographics: one tract per nation, population = its customers."""
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cust = table(spark, sf_dir, "customer").select("c_nationkey")
    pop = cust.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("pop"))
    j = nat.join(pop, nat.n_nationkey == pop.c_nationkey, "left")
    n = F.col("n_nationkey").cast("bigint")
    popc = F.coalesce(F.col("pop"), F.lit(0)).cast("bigint")
    income = F.when(n == 24, F.lit(-666666666)).otherwise(F.lit(20000) + F.lit(6000) * n).cast("bigint")
    households = F.floor(popc / 2) + 1
    return j.select(
        F.format_string("36%03d%06d", F.lit(5), n).alias("geoid"),
        F.lower(F.concat(F.lit("region "), F.col("n_regionkey").cast("string"))).alias("borough"),
        F.lit("005").alias("county_fips"),
        popc.alias("total_population"),
        households.alias("total_households"),
        F.floor((households * n) / 100).alias("households_no_vehicle"),
        income.alias("median_household_income"),
        F.when(n == 7, F.lit(None).cast("bigint")).otherwise(F.floor(popc * n / 50)).alias("population_in_poverty"),
        F.floor((popc * (n % 4)) / 20).alias("population_with_disability"),
        (F.lit(1.0) - n.cast("double") / F.lit(100.0).cast("double")).alias("car_ownership_rate"),
        F.when(n == 7, F.lit(None).cast("double")).otherwise(n.cast("double") / F.lit(50.0).cast("double")).alias("poverty_rate"),
        ((n % 4).cast("double") / F.lit(20.0).cast("double")).alias("disability_rate"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"),
    )


# ---------------------------------------------------------------- census documents (B9)
CENSUS_HEADER = ("NAME", "B19013_001E", "B01003_001E", "B08201_002E", "B08201_001E", "B17001_002E", "B18101_001E",
                 "state", "county", "tract")


def census_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-first JSON documents (one tract per document), as the census API returns them.

    County is '005' / '047' / '999' by ``n % 3`` (the last one has no borough),
    income of tract 3 is the junk string '-', poverty of tract 7 is null.
    """
    c = census_raw(spark, sf_dir)
    n = F.substring("geoid", 6, 6).cast("bigint")
    s = lambda col: F.col(col).cast("string")
    header = F.array(*[F.lit(h) for h in CENSUS_HEADER])
    row = F.array(
        F.concat(F.lit("Census Tract "), n.cast("string")),
        F.when(n == 3, F.lit("-")).otherwise(s("median_household_income")),
        s("total_population"),
        s("households_no_vehicle"),
        s("total_households"),
        s("population_in_poverty"),
        s("population_with_disability"),
        F.lit("36"),
        F.when(n % 3 == 0, "005").when(n % 3 == 1, "047").otherwise("999"),
        F.lpad(n.cast("string"), 6, "0"),
    )
    return c.select(F.to_json(F.array(header, row)).alias("value"))
