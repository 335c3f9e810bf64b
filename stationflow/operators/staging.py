"""Staging: bronze ridership / census rows -> typed, validated silver rows."""

from __future__ import annotations

from functools import reduce

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import dec_sum, initcap_words, season


def _ts(c):
    return F.col(c).try_cast("timestamp_ntz")


def _num(c):
    return F.col(c).try_cast("double")


def _validity(raw: DataFrame) -> F.Column:
    return (
        _ts("transit_timestamp").isNotNull()
        & F.col("station_complex_id").isNotNull()
        & _num("ridership").isNotNull()
        & (_num("ridership") >= 0)
    )


def stg_ridership(raw: DataFrame, normalize_names: bool = True) -> DataFrame:
    """Cast, rename and validate bronze ridership (one row per station x hour x fare class).

    Rows with a NULL timestamp, station or ridership, or negative ridership,
    are dropped here and reported by :func:`stg_rejects`. The filter sits
    below the projection so Catalyst pushes it into the Parquet scan.

    ``normalize_names=False`` leaves ``station_name`` / ``borough`` as spelled
    in the source: the station-keyed aggregates (:func:`monthly_totals`, the
    hub) normalise them after their first level, once per distinct spelling,
    which is exact because INITCAP is idempotent and they take ``max`` of it.
    """
    ts = _ts("transit_timestamp")
    name = (lambda c: initcap_words(c)) if normalize_names else (lambda c: F.col(c))
    return raw.filter(_validity(raw)).select(
        ts.alias("transit_timestamp"),
        F.to_date(ts).alias("transit_date"),
        F.hour(ts).cast("bigint").alias("transit_hour"),
        F.dayofweek(ts).cast("bigint").alias("day_of_week"),
        F.year(ts).cast("bigint").alias("transit_year"),
        F.month(ts).cast("bigint").alias("transit_month"),
        F.col("station_complex_id").cast("string").alias("station_complex_id"),
        name("station_complex").alias("station_name"),
        name("borough").alias("borough"),
        _num("latitude").alias("latitude"),
        _num("longitude").alias("longitude"),
        F.lower("transit_mode").alias("transit_mode"),
        F.lower("payment_method").alias("payment_method"),
        F.lower("fare_class_category").alias("fare_class"),
        _num("ridership").alias("ridership"),
        _num("transfers").alias("transfers"),
    )


def stg_rejects(raw: DataFrame) -> DataFrame:
    """The quarantine side of :func:`stg_ridership`: every dropped row with its reason."""
    reason = (
        F.when(_ts("transit_timestamp").isNull(), "null_timestamp")
        .when(F.col("station_complex_id").isNull(), "null_station")
        .when(_num("ridership").isNull(), "null_ridership")
        .otherwise("negative_ridership")
    )
    return raw.filter(~_validity(raw)).withColumn("reject_reason", reason)


def ridership_all(*parts: DataFrame) -> DataFrame:
    """The staged loads as one table, by column name; a column that a load lacks is NULL on its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_audit(df: DataFrame, name: str = "loaded_at") -> DataFrame:
    """Append the load timestamp (kept out of oracle-compared outputs)."""
    return df.withColumn(name, F.current_timestamp())


def stg_census(raw: DataFrame, sentinels: Sequence[int] = (-666666666,), sentinel_cols: Sequence[str] = ("median_household_income",)) -> DataFrame:
    """Census tract staging: casts, INITCAP borough, sentinel codes -> NULL."""
    def big(c):
        col = F.col(c).try_cast("bigint")
        if c in sentinel_cols:
            for s in sentinels:
                col = F.nullif(col, F.lit(s).cast("bigint"))
        return col.alias(c)

    return raw.select(
        F.col("geoid").cast("string").alias("geoid"),
        initcap_words("borough").alias("borough"),
        F.col("county_fips").cast("string").alias("county_fips"),
        big("total_population"),
        big("total_households"),
        big("households_no_vehicle"),
        big("median_household_income"),
        big("population_in_poverty"),
        big("population_with_disability"),
        F.col("car_ownership_rate").try_cast("double").alias("car_ownership_rate"),
        F.col("poverty_rate").try_cast("double").alias("poverty_rate"),
        F.col("disability_rate").try_cast("double").alias("disability_rate"),
        F.col("loaded_at").try_cast("timestamp_ntz").alias("loaded_at"),
    )


def season_totals(stg: DataFrame) -> DataFrame:
    """Ridership and row counts per year x season (season from the month)."""
    return (
        stg.groupBy(F.col("transit_year").alias("transit_year"), season("transit_month").alias("season"))
        .agg(dec_sum("ridership").alias("total_ridership"), F.count(F.lit(1)).alias("row_count"))
    )


def canonical(df: DataFrame, **names: str) -> DataFrame:
    """A table with other column names, as the operators expect it.

    ``canonical(df, station_complex_id="gare_id", ridership="voyageurs", ...)``
    renames each given column to its canonical name (a projection that Catalyst
    folds into the scan). A column that already has a canonical name but is not
    the one given is dropped.
    """
    sources = {source: target for target, source in names.items()}
    kept = [c for c in df.columns if c in sources or c not in names]
    return df.select(*[F.col(f"`{c}`").alias(sources.get(c, c)) for c in kept])
