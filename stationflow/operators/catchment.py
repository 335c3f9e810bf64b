"""Area-weighted catchment demographics on a raster of square cells.

Spark has no buffer / area / intersection functions, so geometry is replaced
by cells: a station's catchment is the set of cells whose centre lies within
``radius`` of an entrance (union over entrances = ``distinct``), a tract is the
set of cells whose centre lies inside it, and every spatial predicate becomes
an equi-join on ``(cx, cy)``. Intersection area / buffer area is then
``shared cells / buffer cells``. Accuracy is controlled by ``cell`` (see the
tests for the error bound).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import below_tier, rnd, safe_div

INCOME_TIERS = ((40000, "Low Income"), (75000, "Middle Income"), (120000, "Upper Middle Income"))


def project_xy(df: DataFrame, lat: str, lon: str, lat0: float, lon0: float) -> DataFrame:
    """Local equirectangular projection to metres around (lat0, lon0)."""
    r = 6371008.8
    k = math.pi / 180.0
    return df.withColumn("x", (F.col(lon) - F.lit(lon0)) * F.lit(k * r * math.cos(lat0 * k))).withColumn(
        "y", (F.col(lat) - F.lit(lat0)) * F.lit(k * r)
    )


def load_tracts(tracts: DataFrame, state: str, counties: Sequence[str], geometry_cols: Sequence[str] = ("xmin",)) -> DataFrame:
    """Tract geometries of one state's counties with a geometry present (pushed to the scan)."""
    cond = (F.col("state_fips_code") == state) & F.col("county_fips_code").isin(list(counties))
    for g in geometry_cols:
        cond = cond & F.col(g).isNotNull()
    return tracts.filter(cond)


def catchment_cells(entrances: DataFrame, radius: float = 800.0, cell: float = 25.0) -> DataFrame:
    """Cells of the union of ``radius`` discs around each station's entrances.

    ``entrances`` has ``station_complex_id, x, y`` in metres. The disc is taken
    around the entrance's cell centre; each disc row's offsets come from two
    ``sequence`` explodes (narrow, no shuffle, only cells inside the disc) and
    the union over entrances is one ``distinct``.
    """
    rc = int(math.floor(radius / cell))
    r2 = (radius / cell) ** 2
    e = entrances.select(
        "station_complex_id",
        F.floor(F.col("x") / F.lit(cell)).alias("_ix"),
        F.floor(F.col("y") / F.lit(cell)).alias("_iy"),
    )
    # rows of the disc: dx in [-rc, rc], then only the dy of that row (no square-and-filter)
    e = e.withColumn("_dx", F.explode(F.sequence(F.lit(-rc), F.lit(rc))))
    half = F.floor(F.sqrt(F.lit(r2) - (F.col("_dx") * F.col("_dx")).cast("double")) + F.lit(1e-9))
    e = e.withColumn("_dy", F.explode(F.sequence(-half, half)))
    return e.select(
        "station_complex_id",
        (F.col("_ix") + F.col("_dx")).cast("bigint").alias("cx"),
        (F.col("_iy") + F.col("_dy")).cast("bigint").alias("cy"),
    ).distinct()


def tract_cells(tracts: DataFrame, cell: float = 25.0) -> DataFrame:
    """Cells whose centre lies in an axis-aligned tract rectangle [xmin, xmax) x [ymin, ymax)."""
    def lo(c):
        return F.ceil(F.col(c) / F.lit(cell) - F.lit(0.5))

    t = tracts.select(
        "geo_id",
        F.sequence(lo("xmin"), lo("xmax") - 1).alias("_xs"),
        F.sequence(lo("ymin"), lo("ymax") - 1).alias("_ys"),
    )
    t = t.withColumn("cx", F.explode("_xs")).withColumn("cy", F.explode("_ys"))
    return t.select("geo_id", F.col("cx").cast("bigint").alias("cx"), F.col("cy").cast("bigint").alias("cy"))


def tract_cells_polygon(tracts: DataFrame, cell: float = 25.0) -> DataFrame:
    """Cells whose centre lies inside a polygon ring (even-odd rule).

    ``tracts`` has ``geo_id`` and ``ring: array<struct<x: double, y: double>>``
    (closed or open). One row for each (tract, cell row): the x where the
    ring's edges cross the row's centre line, sorted, pair up into spans, and
    only cells inside a span are exploded.
    """
    ring = F.col("ring")
    n = F.size(ring)
    after = lambda i: F.element_at(ring, ((i + 1) % n) + 1)
    edges = F.transform(ring, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), after(i)["x"].alias("x2"), after(i)["y"].alias("y2")))
    low = lambda v: F.ceil(v / F.lit(cell) - 0.5)  # noqa: E731  first cell whose centre is at v or above
    ys = F.transform(ring, lambda p: p["y"])
    t = tracts.select("geo_id", edges.alias("_edges"), low(F.array_min(ys)).alias("_lo"), (low(F.array_max(ys)) - 1).alias("_hi"))
    t = t.filter("_lo <= _hi").withColumn("cy", F.explode(F.sequence("_lo", "_hi")))
    py = (F.col("cy").cast("double") + 0.5) * cell
    crossed = F.filter("_edges", lambda e: (e["y1"] > py) != (e["y2"] > py))
    xs = F.array_sort(F.transform(crossed, lambda e: (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
    t = t.select("geo_id", "cy", xs.alias("_xs")).filter(F.size("_xs") > 1)
    t = t.withColumn("_k", F.explode(F.sequence(F.lit(1), F.size("_xs") - 1, F.lit(2))))
    t = t.select("geo_id", "cy", low(F.element_at("_xs", F.col("_k"))).alias("_a"), (low(F.element_at("_xs", F.col("_k") + 1)) - 1).alias("_b"))
    t = t.filter("_a <= _b").withColumn("cx", F.explode(F.sequence("_a", "_b")))
    return t.select("geo_id", F.col("cx").cast("bigint").alias("cx"), F.col("cy").cast("bigint").alias("cy"))


def catchment_weights(cc: DataFrame, tc: DataFrame) -> DataFrame:
    """Shared cells per (station, tract) and the two area weights.

    ``catchment_weight`` = shared / buffer cells (share of the catchment);
    ``tract_coverage_pct`` = shared / tract cells (share of the tract).
    Each side is built once: its cells are counted by a window over its own
    id (a buffer or a tract is bounded), then one equi-join on the cell.
    """
    per = lambda c: F.count(F.lit(1)).over(Window.partitionBy(c))
    cc = cc.select("station_complex_id", "cx", "cy", per("station_complex_id").alias("buffer_cells"))
    tc = tc.select("geo_id", "cx", "cy", per("geo_id").alias("tract_cells"))
    j = cc.join(tc, ["cx", "cy"]).groupBy("station_complex_id", "geo_id", "buffer_cells", "tract_cells")
    return j.agg(F.count(F.lit(1)).alias("intersect_cells")).select(
        "station_complex_id",
        "geo_id",
        "intersect_cells",
        "buffer_cells",
        "tract_cells",
        safe_div("intersect_cells", "buffer_cells").alias("catchment_weight"),
        safe_div("intersect_cells", "tract_cells").alias("tract_coverage_pct"),
    )


def catchment_head_count(weights: DataFrame, census: DataFrame) -> DataFrame:
    """People living in each catchment: every tract's population times the share of the tract inside.

    (:func:`catchment_demographics` weighs by the share of the catchment instead.)
    """
    c = census.select(F.col("geoid").alias("_geoid"), "total_population")
    j = weights.join(c, weights.geo_id == c._geoid, "left")
    share = safe_div(F.col("total_population") * F.col("intersect_cells"), "tract_cells")
    return j.groupBy("station_complex_id").agg(F.sum(rnd(share, 6).cast("decimal(24,6)")).cast("double").alias("head_count"))


def weighted_mean_expr(x: str, w: str, null_aware: bool = True, scale: int = 6) -> F.Column:
    """Aggregate expression: weighted mean of ``x``, summed exactly as DECIMAL.

    ``null_aware=True`` drops NULL ``x`` from numerator and denominator;
    ``False`` keeps their weight in the denominator (a NULL rate counts as 0),
    as the warehouse model does for its rate columns.
    """
    xd = F.col(x).cast(f"decimal(20,{scale})")
    wd = F.col(w).cast(f"decimal(16,{scale})")
    den = F.sum(F.when(F.col(x).isNotNull(), wd)) if null_aware else F.sum(wd)
    return safe_div(F.sum(xd * wd), den)


def weighted_mean(df: DataFrame, group: list[str], x: str, w: str, null_aware: bool = True, scale: int = 6) -> DataFrame:
    """Weighted mean of ``x`` per group (see :func:`weighted_mean_expr`)."""
    return df.groupBy(*group).agg(weighted_mean_expr(x, w, null_aware, scale).alias(f"weighted_{x}"))


def _wmean(x: str, null_aware: bool, n: str = "intersect_cells") -> F.Column:
    num = F.sum(F.col(x).cast("decimal(16,6)") * F.col(n))
    den = F.sum(F.when(F.col(x).isNotNull(), F.col(n))) if null_aware else F.sum(F.col(n))
    return safe_div(num, den)


def catchment_demographics(
    weights: DataFrame,
    census: DataFrame,
    stations: DataFrame,
    null_aware_rates: bool = False,
    income_tiers=INCOME_TIERS,
    null_income_tier: str | None = None,
) -> DataFrame:
    """Per-station area-weighted demographics and income tier.

    Weights are shared-cell counts (the buffer size cancels in a weighted
    mean, so sums stay exact integers / decimals). Income is NULL-aware;
    rates follow ``null_aware_rates`` (default: the warehouse behaviour).
    A NULL income gets tier ``null_income_tier`` (default NULL, not 'High').
    """
    c = census.select(
        F.col("geoid").alias("_geoid"),
        "median_household_income",
        "total_population",
        "poverty_rate",
        "car_ownership_rate",
        "disability_rate",
    )
    j = weights.join(c, weights.geo_id == c._geoid, "left")
    g = j.groupBy("station_complex_id").agg(
        F.count("geo_id").alias("tracts_in_catchment"),
        F.count_if(F.col("median_household_income").isNotNull()).alias("tracts_with_demographic_data"),
        safe_div(F.sum(F.col("total_population") * F.col("intersect_cells")), F.max("buffer_cells")).alias("_pop"),
        _wmean("median_household_income", True).alias("_inc"),
        _wmean("poverty_rate", null_aware_rates).alias("_pov"),
        _wmean("car_ownership_rate", null_aware_rates).alias("_car"),
        _wmean("disability_rate", null_aware_rates).alias("_dis"),
    )
    s = stations.select(F.col("station_complex_id").alias("_sid"), "station_name", "borough", "latitude", "longitude")
    g = g.join(s, g.station_complex_id == s._sid, "left")
    return g.select(
        "station_complex_id",
        "station_name",
        "borough",
        "latitude",
        "longitude",
        "tracts_in_catchment",
        "tracts_with_demographic_data",
        rnd("_pop", 2).alias("catchment_population"),
        rnd("_inc", 2).alias("weighted_mean_income"),
        rnd("_pov", 4).alias("weighted_poverty_rate"),
        rnd("_car", 4).alias("weighted_car_ownership_rate"),
        rnd("_dis", 4).alias("weighted_disability_rate"),
        below_tier(rnd("_inc", 2), income_tiers, "High Income", null_income_tier).alias("income_tier"),
    )
