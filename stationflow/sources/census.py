"""Census tract rows from header-first JSON documents, and their derived fields."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import rnd, safe_div

# Census variable codes and the names the pipeline gives them.
CENSUS_VARIABLES = {
    "B19013_001E": "median_household_income",
    "B01003_001E": "total_population",
    "B08201_002E": "households_no_vehicle",
    "B08201_001E": "total_households",
    "B17001_002E": "population_in_poverty",
    "B18101_001E": "population_with_disability",
    "NAME": "neighborhood_name",
}

# County FIPS code -> borough.
COUNTY_BOROUGH = {"005": "Bronx", "047": "Brooklyn", "061": "Manhattan", "081": "Queens", "085": "Staten Island"}

NUMERIC_COLUMNS = tuple(name for name in CENSUS_VARIABLES.values() if name != "neighborhood_name")


def rows_from_header_json(docs: DataFrame, text_col: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    """Parse ``[[header...], [row...], ...]`` documents into one row per data row.

    Each input row holds one document (read with ``spark.read.text``, one per
    line, or ``wholetext`` for one per file), so parsing is spread over files
    and lines. Cells stay strings; ``columns`` selects and orders the output
    (default: the first document's header is not known up front, so pass it).
    """
    if columns is None:
        raise ValueError("columns must be given")
    d = _parsed(docs, text_col).filter("reject_reason IS NULL")
    d = d.select(F.element_at("_a", 1).alias("_h"), F.explode(F.slice("_a", 2, F.size("_a") - 1)).alias("_row"))
    d = d.filter(F.size("_h") == F.size("_row")).select(F.map_from_arrays("_h", "_row").alias("_m"))
    return d.select(*[F.col("_m")[c].alias(c) for c in columns])


def _parsed(docs: DataFrame, text_col: str) -> DataFrame:
    """Each document as an array of arrays ``_a``, with the reason if it holds no rows."""
    arr = F.from_json(F.col(text_col), "array<array<string>>")
    reason = (
        F.when(F.col("_t").isNull() | (F.trim("_t") == ""), "empty")
        .when(F.col("_a").isNull() | F.exists("_a", lambda r: r.isNull()), "malformed")
        .when(F.size("_a") == 0, "no_header")
    )
    return docs.select(F.col(text_col).alias("_t"), arr.alias("_a")).withColumn("reject_reason", reason)


def census_rejects(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """What :func:`rows_from_header_json` leaves out: whole documents, and rows whose cells do not fit the header."""
    p = _parsed(docs, text_col)
    whole = p.filter("reject_reason IS NOT NULL").select(F.col("_t").alias("document"), F.lit(None).cast("int").alias("row"), "reject_reason")
    rows = p.filter("reject_reason IS NULL").select("_t", F.element_at("_a", 1).alias("_h"), F.posexplode(F.slice("_a", 2, F.size("_a") - 1)).alias("_p", "_row"))
    bad = rows.filter(F.size("_h") != F.size("_row")).select(F.col("_t").alias("document"), (F.col("_p") + 1).alias("row"), F.lit("cell_count").alias("reject_reason"))
    return whole.unionByName(bad)


def rename_variables(df: DataFrame, mapping=CENSUS_VARIABLES) -> DataFrame:
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def coerce_numeric(df: DataFrame, cols: Sequence[str] = NUMERIC_COLUMNS, to: str = "double") -> DataFrame:
    """Lenient numeric cast: unparsable strings become NULL (never raise)."""
    out = df
    for c in cols:
        if c in df.columns:
            out = out.withColumn(c, F.col(c).try_cast("double").cast(to) if to != "double" else F.col(c).try_cast("double"))
    return out


def demographic_rates(df: DataFrame, digits: int = 4) -> DataFrame:
    """Car ownership, poverty and disability rates; NULL on a zero or missing denominator."""
    return df.select(
        "*",
        rnd(F.lit(1.0) - safe_div("households_no_vehicle", "total_households"), digits).alias("car_ownership_rate"),
        rnd(safe_div("population_in_poverty", "total_population"), digits).alias("poverty_rate"),
        rnd(safe_div("population_with_disability", "total_population"), digits).alias("disability_rate"),
    )


def with_geoid(df: DataFrame, state: str = "state", county: str = "county", tract: str = "tract", boroughs=COUNTY_BOROUGH) -> DataFrame:
    """``geoid = state || county || tract`` and the county's borough ('Unknown' if unmapped)."""
    m = F.create_map(*[x for k, v in boroughs.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn("geoid", F.concat(F.col(state), F.col(county), F.col(tract))).withColumn(
        "borough", F.coalesce(m[F.col(county)], F.lit("Unknown"))
    )


def union_parts(*dfs: DataFrame) -> DataFrame:
    """Append frames by column name; a column missing from a part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def sample_head(df: DataFrame, key: Sequence[str] | str, n: int = 20) -> DataFrame:
    """Deterministic first ``n`` rows by ``key`` (a top-n, planned as TakeOrderedAndProject)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)
