"""Gold marts that combine the chains, and the published KPIs over them.

Inputs here are already at station x year (or station x period) grain, so
every join is between reduced tables; the station-keyed sides are
dimension-sized and are broadcast by Spark when under its size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import null_greatest, null_least, rnd, safe_div, tier
from stationflow.operators.congestion import INTENSITY_TIERS

EQUITY_TIERS = ((60, "High Risk"), (35, "Moderate Risk"))


def efficiency_matrix(
    mart: DataFrame, scorecard: DataFrame, high_index: float = 8.0, recovered: float = 70.0, intensity=INTENSITY_TIERS
) -> DataFrame:
    """Congestion mart rows with the station-year recovery and an efficiency quadrant.

    A NULL recovery falls to 'Underutilized' (both comparisons are unknown),
    as in the warehouse CASE.
    """
    rec = scorecard.filter(F.col("record_type") == "station").select(
        F.col("station_complex_id").alias("_sid"),
        F.col("transit_year").alias("_yr"),
        "recovery_pct",
        F.col("data_quality_flag").alias("recovery_dq_flag"),
    )
    c = mart.withColumnRenamed("ridership_year", "transit_year")
    j = c.join(rec, (c.station_complex_id == rec._sid) & (c.transit_year == rec._yr), "left")
    idx, pct = F.col("avg_congestion_index"), F.col("recovery_pct")
    quad = (
        F.when((idx >= high_index) & (pct >= recovered), "Thriving but Strained")
        .when((idx >= high_index) & (pct < recovered), "Structural Bottleneck")
        .when((idx < high_index) & (pct >= recovered), "Healthy Spare Capacity")
        .otherwise("Underutilized")
    )
    return j.select(
        "station_complex_id",
        "station_name",
        "borough",
        "transit_year",
        "season",
        "day_of_week",
        "time_period",
        "latitude",
        "longitude",
        "avg_hourly_ridership",
        "median_hourly_ridership",
        "observation_count",
        "avg_congestion_index",
        "congestion_intensity_tier",
        "most_common_peak_hour",
        "recovery_pct",
        "recovery_dq_flag",
        quad.alias("efficiency_quadrant"),
        tier(idx, intensity, "Off Peak").alias("congestion_tier"),
    )


def equity_score(
    scorecard: DataFrame,
    annual: DataFrame,
    demo: DataFrame,
    gap: float = 20.0,
    disruption: float = 10.0,
    income: tuple[float, float] = (60000.0, 20000.0),
    points: tuple[float, float, float] = (33.0, 33.0, 34.0),
    tiers=EQUITY_TIERS,
    null_tier: str | None = None,
) -> DataFrame:
    """0-100 equity risk score per clean station-year.

    Each component saturates at 1 and any NULL component makes the score NULL
    (warehouse LEAST/GREATEST semantics; Spark's skip NULLs). A NULL score
    gets tier ``null_tier`` (default NULL; the warehouse CASE gave 'Low Risk').
    """
    rec = scorecard.filter(F.col("record_type") == "station").select(
        "station_complex_id",
        "station_name",
        "borough",
        "latitude",
        "longitude",
        "transit_year",
        "annual_ridership",
        "recovery_pct",
        "borough_avg_recovery_pct",
        "data_quality_flag",
    )
    u = annual.select(
        F.col("station_complex_id").alias("_usid"),
        F.col("transit_year").alias("_uyr"),
        "avg_demand_intensity",
        "disruption_rate_per_1k_hours",
    )
    d = demo.select(F.col("station_complex_id").alias("_dsid"), "weighted_mean_income", "weighted_poverty_rate", "income_tier")
    j = rec.filter(F.col("data_quality_flag") == "clean")
    j = j.join(u, (j.station_complex_id == u._usid) & (j.transit_year == u._uyr), "left").join(
        d, F.col("station_complex_id") == d._dsid, "left"
    )
    c1 = null_least(safe_div(null_greatest(F.col("borough_avg_recovery_pct") - F.col("recovery_pct"), F.lit(0.0)), F.lit(gap)), F.lit(1.0))
    c2 = null_least(safe_div(F.col("disruption_rate_per_1k_hours"), F.lit(disruption)), F.lit(1.0))
    c3 = null_least(
        safe_div(null_greatest(F.lit(income[0]) - F.col("weighted_mean_income"), F.lit(0.0)), F.lit(income[1])), F.lit(1.0)
    )
    score = rnd(c1 * points[0] + c2 * points[1] + c3 * points[2], 1)
    out = j.select(
        "station_complex_id",
        "station_name",
        "borough",
        "latitude",
        "longitude",
        "transit_year",
        "annual_ridership",
        "recovery_pct",
        "borough_avg_recovery_pct",
        "avg_demand_intensity",
        "disruption_rate_per_1k_hours",
        "weighted_mean_income",
        "weighted_poverty_rate",
        "income_tier",
        "data_quality_flag",
        score.alias("equity_risk_score"),
    )
    return out.withColumn("equity_risk_tier", tier("equity_risk_score", tiers, "Low Risk", null_tier))


# ------------------------------------------------------------------ KPIs
def kpi_disruption_intensity(daily: DataFrame, period: str = "ridership_year") -> DataFrame:
    """Disruption hours per million riders, per period."""
    g = daily.groupBy(period).agg(
        F.sum("disruption_hours").alias("disruption_hours"),
        F.sum(F.col("daily_ridership").cast("decimal(18,2)")).alias("_riders"),
    )
    return g.select(
        period,
        "disruption_hours",
        F.col("_riders").cast("double").alias("total_ridership"),
        rnd(safe_div(F.col("disruption_hours") * 1000000, F.col("_riders")), 4).alias("disruption_hours_per_million"),
    )


def kpi_disruption_share(daily: DataFrame) -> DataFrame:
    """Each borough's share of all disruption hours."""
    g = daily.groupBy("borough").agg(F.sum("disruption_hours").alias("disruption_hours"))
    # the grand total is a window over the aggregate: one row per borough, a fixed geography
    total = F.sum("disruption_hours").over(Window.partitionBy())
    return g.select("borough", "disruption_hours", rnd(safe_div(F.col("disruption_hours") * 100, total), 2).alias("share_pct"))


def kpi_disruption_change(daily: DataFrame, period: str = "year") -> DataFrame:
    """Period-over-period change of disruption hours by borough (year / month / week)."""
    unit = {"year": "year", "month": "month", "week": "week"}[period]
    p = F.date_trunc(unit, F.col("transit_date")).cast("date")
    g = daily.groupBy("borough", p.alias("period_start")).agg(F.sum("disruption_hours").alias("disruption_hours"))
    w = Window.partitionBy("borough").orderBy("period_start")
    prev = F.lag("disruption_hours").over(w)
    return g.select(
        "borough",
        "period_start",
        "disruption_hours",
        prev.alias("prev_disruption_hours"),
        rnd(safe_div(F.col("disruption_hours") - prev, prev) * 100, 2).alias("change_pct"),
    )


def kpi_risk_profile(equity: DataFrame) -> DataFrame:
    """Mean income, recovery and disruption rate, and station count, per risk tier."""
    g = equity.groupBy("transit_year", "equity_risk_tier").agg(
        F.count(F.lit(1)).alias("stations"),
        F.sum(F.col("weighted_mean_income").cast("decimal(18,2)")).alias("_inc"),
        F.count("weighted_mean_income").alias("_ninc"),
        F.sum(F.col("recovery_pct").cast("decimal(18,2)")).alias("_rec"),
        F.count("recovery_pct").alias("_nrec"),
        F.sum(F.col("disruption_rate_per_1k_hours").cast("decimal(18,2)")).alias("_dis"),
        F.count("disruption_rate_per_1k_hours").alias("_ndis"),
    )
    return g.select(
        "transit_year",
        "equity_risk_tier",
        "stations",
        rnd(safe_div("_inc", "_ninc"), 2).alias("avg_income"),
        rnd(safe_div("_rec", "_nrec"), 2).alias("avg_recovery_pct"),
        rnd(safe_div("_dis", "_ndis"), 2).alias("avg_disruption_rate"),
    )


def kpi_quality_counts(scorecard: DataFrame) -> DataFrame:
    """Per year: critical, clean and flagged station counts."""
    st = scorecard.filter(F.col("record_type") == "station")
    return st.groupBy("transit_year").agg(
        F.count_if(F.col("recovery_tier") == "Critical").alias("critical_stations"),
        F.count_if(F.col("data_quality_flag") == "clean").alias("clean_stations"),
        F.count_if(F.col("data_quality_flag") != "clean").alias("flagged_stations"),
        F.count(F.lit(1)).alias("stations"),
    )


def kpi_income_gap(demo: DataFrame) -> DataFrame:
    """Range of station catchment incomes."""
    return demo.agg(
        F.min("weighted_mean_income").alias("min_income"),
        F.max("weighted_mean_income").alias("max_income"),
        (F.max("weighted_mean_income") - F.min("weighted_mean_income")).alias("income_gap"),
        F.count("weighted_mean_income").alias("stations_with_income"),
    )


def kpi_system_recovery(monthly: DataFrame, baseline_year: int = 2019) -> DataFrame:
    """Recovery per year for the whole system and per borough (ROLLUP year, borough)."""
    g = monthly.rollup(F.col("ridership_year").alias("transit_year"), "borough").agg(
        F.sum(F.col("monthly_ridership").cast("decimal(18,2)")).alias("_cur"),
        F.sum(F.col(f"baseline_monthly_{baseline_year}").cast("decimal(18,2)")).alias("_base"),
        F.grouping_id().alias("_gid"),
    )
    g = g.filter(F.col("_gid") < 3)
    return g.select(
        "transit_year",
        F.when(F.col("_gid") == 1, F.lit("System")).otherwise(F.col("borough")).alias("scope"),
        F.col("_cur").cast("double").alias("annual_ridership"),
        F.col("_base").cast("double").alias(f"annual_baseline_{baseline_year}"),
        rnd(safe_div("_cur", "_base") * 100, 2).alias("recovery_pct"),
    )


def kpi_row_reduction(hourly: DataFrame, mart: DataFrame) -> DataFrame:
    """Rows in the hourly table vs the mart, and the reduction percentage.

    Both counts come from one aggregate over a union of indicator rows (no join).
    """
    u = hourly.select(F.lit(1).alias("_h"), F.lit(0).alias("_m")).unionByName(
        mart.select(F.lit(0).alias("_h"), F.lit(1).alias("_m"))
    )
    g = u.agg(F.sum("_h").cast("bigint").alias("hourly_rows"), F.sum("_m").cast("bigint").alias("mart_rows"))
    return g.select(
        "hourly_rows",
        "mart_rows",
        rnd(safe_div((F.col("hourly_rows") - F.col("mart_rows")) * 100, F.col("hourly_rows")), 2).alias("reduction_pct"),
    )


def kpi_index_by_class(hourly: DataFrame) -> DataFrame:
    """Mean station congestion index per hour class."""
    g = hourly.groupBy("hour_classification").agg(
        F.sum(F.col("station_congestion_index").cast("decimal(18,3)")).alias("_s"),
        F.count("station_congestion_index").alias("hours"),
    )
    return g.select("hour_classification", "hours", rnd(safe_div("_s", "hours"), 3).alias("mean_congestion_index"))
