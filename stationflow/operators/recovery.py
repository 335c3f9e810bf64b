"""Recovery against a baseline year: monthly, borough and scorecard grains.

All inputs here are staged ridership rows; the first step of every operator
is a grouped aggregate with map-side partial aggregation, after which the
data is at station x month grain (small), so windows and joins downstream
work on a reduced dataset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import initcap_words
from stationflow.functions import dec_avg, dec_sum, rnd, safe_div, season, tier
from stationflow.operators.common import rollup_with_attrs

RECOVERY_TIERS = ((90, "Recovered"), (70, "Recovering"), (50, "Lagging"))


def monthly_totals(stg: DataFrame) -> DataFrame:
    """Ridership per station x year x month (+ name, borough, mean coordinates).

    Grouped by station id (name and borough carried as ``max``), so a renamed
    station is not split in two; see :func:`rollup_with_attrs` for why the
    names ride as hash keys first.
    """
    g = rollup_with_attrs(
        stg,
        keys=["station_complex_id", "transit_year", "transit_month"],
        attrs=["station_name", "borough"],
        sums={"_r": ("ridership", 18, 2), "_lat": ("latitude", 12, 6), "_lon": ("longitude", 12, 6)},
        counts={"_nlat": "latitude", "_nlon": "longitude"},
        attr_fn=initcap_words,
    )
    return monthly_columns(g)


def monthly_columns(g: DataFrame) -> DataFrame:
    """The columns of :func:`monthly_totals` from station x year x month sums (``_r``, ``_lat``, ``_lon``) and counts (``_nlat``, ``_nlon``)."""
    return g.select(
        "station_complex_id",
        "station_name",
        "borough",
        rnd(safe_div("_lat", "_nlat"), 6).alias("latitude"),
        rnd(safe_div("_lon", "_nlon"), 6).alias("longitude"),
        F.col("transit_year").alias("ridership_year"),
        F.col("transit_month").alias("ridership_month"),
        F.make_date("transit_year", "transit_month", F.lit(1)).alias("ridership_month_date"),
        F.col("_r").cast("double").alias("monthly_ridership"),
    )


def mom_change(monthly: DataFrame, strict: bool = False) -> DataFrame:
    """Month-over-month change per station.

    Default compares with the previous *row* (a missing month compares with an
    older one, as the warehouse ``lag`` does). ``strict=True`` compares only
    with the calendar month before: the same ``lag``, kept only when the
    previous row is exactly one month earlier (NULL across a gap). One window,
    no self-join.
    """
    m = monthly.select("station_complex_id", "ridership_month_date", "monthly_ridership")
    w = Window.partitionBy("station_complex_id").orderBy("ridership_month_date")
    prev = F.lag("monthly_ridership").over(w)
    if strict:
        adjacent = F.lag("ridership_month_date").over(w) == F.add_months("ridership_month_date", -1)
        prev = F.when(adjacent, prev)
    out = m.withColumn("prev_month_ridership", prev)
    return out.withColumn(
        "month_over_month_pct",
        rnd(safe_div(F.col("monthly_ridership") - F.col("prev_month_ridership"), F.col("prev_month_ridership")) * 100, 2),
    )


def recovery_monthly(
    stg: DataFrame,
    base_stg: DataFrame | None = None,
    baseline_year: int = 2019,
    current_years: Sequence[int] | None = None,
    merged_above: float = 200,
    split_below: float = 25,
    tiers=RECOVERY_TIERS,
    null_tier: str | None = "__else__",
) -> DataFrame:
    """Month vs the same month of the baseline year, per station.

    ``stg`` holds the current rows and (or, with ``base_stg``, is unioned
    with) the baseline-year rows. One grouped aggregate builds station x
    year x month totals; the baseline month and the baseline annual total
    are conditional window sums over (station, month) and (station) on that
    small table, which equals the two left joins of the warehouse model
    without a second scan of the source. The lag runs over current months
    only, ordered by month.
    """
    src = stg if base_stg is None else stg.unionByName(base_stg)
    return recovery_from_monthly(
        monthly_totals(src), baseline_year, current_years, merged_above, split_below, tiers, null_tier
    )


def recovery_from_monthly(
    m: DataFrame,
    baseline_year: int = 2019,
    current_years: Sequence[int] | None = None,
    merged_above: float = 200,
    split_below: float = 25,
    tiers=RECOVERY_TIERS,
    null_tier: str | None = "__else__",
) -> DataFrame:
    """:func:`recovery_monthly` from already aggregated :func:`monthly_totals` rows."""
    by = str(baseline_year)
    is_base = F.col("ridership_year") == baseline_year
    base_r = F.when(is_base, F.col("monthly_ridership").cast("decimal(18,2)"))
    m = m.select(
        "*",
        F.sum(base_r).over(Window.partitionBy("station_complex_id", "ridership_month")).alias("_base_m"),
        F.sum(base_r).over(Window.partitionBy("station_complex_id")).alias("_base_a"),
    )
    cur = m.filter(~is_base) if current_years is None else m.filter(F.col("ridership_year").isin(*current_years))
    w = Window.partitionBy("station_complex_id").orderBy("ridership_month_date")
    j = cur.select(
        *[c for c in cur.columns if not c.startswith("_")],
        F.col("_base_m").cast("double").alias(f"baseline_monthly_{by}"),
        F.col("_base_a").cast("double").alias(f"baseline_annual_{by}"),
        rnd(safe_div("monthly_ridership", F.col("_base_m")) * 100, 2).alias("monthly_recovery_pct"),
        F.lag("monthly_ridership").over(w).alias("prev_month_ridership"),
    )
    pct = F.col("monthly_recovery_pct")
    flag = (
        F.when(pct > merged_above, "suspect_merged")
        .when(pct < split_below, "suspect_split")
        .when(F.col(f"baseline_monthly_{by}").isNull(), "no_baseline")
        .otherwise("clean")
    )
    return j.select(
        "*",
        rnd(safe_div(F.col("monthly_ridership") - F.col("prev_month_ridership"), F.col("prev_month_ridership")) * 100, 2).alias(
            "month_over_month_pct"
        ),
        flag.alias("data_quality_flag"),
        season("ridership_month").alias("season"),
        tier(pct, tiers, "Critical", null_tier).alias("recovery_tier"),
    )


def _year_pct(annual: str, base: str) -> F.Column:
    return rnd(safe_div(F.col(annual), F.col(base)) * 100, 2)


def _avg2(c: str, w: Window) -> F.Column:
    """Window mean of a 2-decimal column, exact (decimal sum / count)."""
    return safe_div(F.sum(F.col(c).cast("decimal(18,2)")).over(w), F.count(F.col(c)).over(w))


def recovery_borough(monthly: DataFrame, include_suspect: bool = True, baseline_year: int = 2019) -> DataFrame:
    """Borough x year recovery (the coded gold mart).

    ``include_suspect=True`` aggregates every station ('system_inclusive');
    ``False`` only months flagged clean. Deviation is from the unweighted
    mean of the boroughs' recovery in that year.
    """
    by = str(baseline_year)
    src = monthly if include_suspect else monthly.filter(F.col("data_quality_flag") == "clean")
    agg = src.groupBy("borough", F.col("ridership_year").alias("transit_year")).agg(
        dec_sum("monthly_ridership").alias("annual_ridership"),
        dec_sum(f"baseline_monthly_{by}").alias(f"annual_baseline_{by}"),
    )
    w = Window.partitionBy("transit_year")
    out = agg.select(
        F.lit("borough").alias("record_type"),
        "transit_year",
        "borough",
        F.lit(None).cast("string").alias("station_complex_id"),
        F.concat(F.col("borough"), F.lit(" Total System")).alias("display_name"),
        "annual_ridership",
        f"annual_baseline_{by}",
        _year_pct("annual_ridership", f"annual_baseline_{by}").alias("recovery_pct"),
        F.lit("system_inclusive" if include_suspect else "clean_only").alias("data_quality_flag"),
    )
    return out.select(
        "*",
        tier("recovery_pct", RECOVERY_TIERS, "Critical", "N/A").alias("recovery_tier"),
        rnd(F.col("recovery_pct") - _avg2("recovery_pct", w), 2).alias("pct_vs_system_avg"),
    )


# Flag severity order used when a year is flagged by its worst month.
FLAG_ORDER = ("suspect_merged", "suspect_split", "no_baseline", "clean")


def _flag_rank(c: str) -> F.Column:
    expr = None
    for i, f in enumerate(FLAG_ORDER):
        expr = F.when(F.col(c) == f, i) if expr is None else expr.when(F.col(c) == f, i)
    return expr.otherwise(len(FLAG_ORDER))


def _flag_name(c: F.Column) -> F.Column:
    expr = None
    for i, f in enumerate(FLAG_ORDER):
        expr = F.when(c == i, f) if expr is None else expr.when(c == i, f)
    return expr.otherwise(F.lit(None).cast("string"))


def recovery_scorecard(monthly: DataFrame, baseline_year: int = 2019, include_suspect_in_borough: bool = False) -> DataFrame:
    """Station x year rows UNION borough x year rows (the documented scorecard), in one pass.

    A station-year takes the worst flag of its months. Borough figures (the
    clean-station mean, and the borough row's sums and centroid) are window
    aggregates over (borough, year) on the station rows; the first station of
    each group also emits the borough row (``explode`` of a two-element
    array), so the station aggregate is computed once rather than once per
    branch of a union.
    """
    by = str(baseline_year)
    st = monthly.groupBy("station_complex_id", F.col("ridership_year").alias("transit_year")).agg(
        F.max("station_name").alias("station_name"),
        F.max("borough").alias("borough"),
        rnd(dec_avg("latitude", 12, 6), 6).alias("latitude"),
        rnd(dec_avg("longitude", 12, 6), 6).alias("longitude"),
        dec_sum("monthly_ridership").alias("annual_ridership"),
        dec_sum(f"baseline_monthly_{by}").alias(f"annual_baseline_{by}"),
        F.min(_flag_rank("data_quality_flag")).alias("_flag"),
    )
    st = st.withColumn("recovery_pct", _year_pct("annual_ridership", f"annual_baseline_{by}")).withColumn(
        "data_quality_flag", _flag_name(F.col("_flag"))
    )
    member = F.lit(True) if include_suspect_in_borough else (F.col("data_quality_flag") == "clean")
    w = Window.partitionBy("borough", "transit_year")

    def msum(c, p=18, s=2):
        return F.sum(F.when(member, F.col(c).cast(f"decimal({p},{s})"))).over(w)

    def mcount(c):
        return F.count(F.when(member, F.col(c))).over(w)

    st = st.select(
        "*",
        rnd(safe_div(msum("recovery_pct"), mcount("recovery_pct")), 2).alias("borough_avg_recovery_pct"),
        msum("annual_ridership").cast("double").alias("_b_annual"),
        msum(f"annual_baseline_{by}").cast("double").alias("_b_base"),
        rnd(safe_div(msum("latitude", 12, 6), mcount("latitude")), 6).alias("_b_lat"),
        rnd(safe_div(msum("longitude", 12, 6), mcount("longitude")), 6).alias("_b_lon"),
        F.count_if(member).over(w).alias("_b_n"),
        F.row_number().over(w.orderBy("station_complex_id")).alias("_rn"),
    )
    fields = ["record_type", "transit_year", "borough", "station_complex_id", "station_name", "latitude", "longitude",
              "annual_ridership", f"annual_baseline_{by}", "recovery_pct", "data_quality_flag", "borough_avg_recovery_pct"]
    station_row = F.struct(
        F.lit("station").alias(fields[0]), F.col("transit_year"), F.col("borough"), F.col("station_complex_id"),
        F.col("station_name"), F.col("latitude"), F.col("longitude"), F.col("annual_ridership"),
        F.col(f"annual_baseline_{by}"), F.col("recovery_pct"), F.col("data_quality_flag"), F.col("borough_avg_recovery_pct"),
    )
    borough_row = F.when(
        (F.col("_rn") == 1) & (F.col("_b_n") > 0),
        F.struct(
            F.lit("borough").alias(fields[0]), F.col("transit_year"), F.col("borough"),
            F.lit(None).cast("string").alias("station_complex_id"), F.lit("Borough Average").alias("station_name"),
            F.col("_b_lat").alias("latitude"), F.col("_b_lon").alias("longitude"),
            F.col("_b_annual").alias("annual_ridership"), F.col("_b_base").alias(f"annual_baseline_{by}"),
            _year_pct("_b_annual", "_b_base").alias("recovery_pct"), F.lit("clean").alias("data_quality_flag"),
            F.col("borough_avg_recovery_pct"),
        ),
    )
    rows = st.select(F.explode(F.filter(F.array(station_row, borough_row), lambda r: r.isNotNull())).alias("_r"))
    out = rows.select(*[F.col("_r")[f].alias(f) for f in fields])
    return out.select(
        "*",
        tier("recovery_pct", RECOVERY_TIERS, "Critical", "N/A").alias("recovery_tier"),
        rnd(F.col("recovery_pct") - F.col("borough_avg_recovery_pct"), 2).alias("pct_vs_borough_avg"),
    )


def crosswalk_recovery(cur_stg: DataFrame, base_stg: DataFrame, crosswalk: DataFrame, baseline_year: int = 2019) -> DataFrame:
    """Re-key the baseline through an old-id -> new-id crosswalk, then recover.

    ``crosswalk`` has ``old_id, new_id, share`` (share splits one old id over
    several new ids; many old ids may map to one new id). Unmapped baseline ids
    keep their id. Both sides are aggregated to station x month first, so the
    join moves monthly rows; a month's parts are added up exactly and rounded
    to cents once, with the cents left over by rounding going to the parts in
    id order, so the parts of a split add up to the whole.
    """
    cw = crosswalk.select(F.col("old_id"), F.col("new_id"), F.col("share").cast("decimal(9,6)").alias("share"))
    base = monthly_totals(base_stg)
    j = base.join(cw, base.station_complex_id == cw.old_id, "left")
    whole = F.col("monthly_ridership").cast("decimal(18,2)")
    # shares of an old id up to and with this one: consecutive differences of the rounded running parts add up
    upto = Window.partitionBy("station_complex_id", "ridership_month_date").orderBy("new_id")
    share = F.coalesce("share", F.lit(1))
    running = F.sum(share).over(upto.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(9,6)")
    before = F.coalesce(F.sum(share).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(9,6)")
    part = F.round(whole * running, 2) - F.round(whole * before, 2)
    j = j.select("*", part.cast("decimal(18,2)").alias("_part"))
    keyed = j.select(
        F.coalesce("new_id", "station_complex_id").alias("station_complex_id"), "station_name", "borough", "latitude", "longitude",
        "ridership_year", "ridership_month", "ridership_month_date", "_part",
    )
    by_new = keyed.groupBy("station_complex_id", "ridership_year", "ridership_month", "ridership_month_date").agg(
        F.max("station_name").alias("station_name"), F.max("borough").alias("borough"), F.max("latitude").alias("latitude"),
        F.max("longitude").alias("longitude"), F.sum("_part").cast("double").alias("monthly_ridership"),
    )
    return recovery_from_monthly(monthly_totals(cur_stg).unionByName(by_new), baseline_year)
