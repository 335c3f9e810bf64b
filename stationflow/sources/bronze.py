"""Bronze scans, time slices, landing layout and gold materialisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from stationflow.operators.quality import contract_gold

# Fixed value: the bronze ridership columns, all read as strings.
RIDERSHIP_BRONZE_COLUMNS = (
    "transit_timestamp", "transit_mode", "station_complex_id", "station_complex", "borough",
    "payment_method", "fare_class_category", "ridership", "transfers", "latitude", "longitude",
)


def string_schema(cols: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def read_bronze(spark: SparkSession, root: str, schema: StructType, fmt: str = "csv", corrupt_col: str | None = None) -> DataFrame:
    """Scan a partitioned bronze directory (``year=/month=/...``) with an explicit schema.

    No inference pass; partition columns are discovered from the path and
    pruned by filters on them. Malformed CSV lines are kept (PERMISSIVE) and,
    with ``corrupt_col``, the whole line is carried in that column (null for
    a well-formed one).
    """
    if corrupt_col and corrupt_col not in schema.names:
        schema = StructType([*schema.fields, StructField(corrupt_col, StringType(), True)])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
        if corrupt_col:
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        return reader.csv(root)
    return reader.format(fmt).load(root)


def time_slice(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Half-open ``[start, end)`` extraction; pushed into the Parquet scan as two range filters."""
    c = F.col(ts)
    return df.filter((c >= F.lit(start).cast(df.schema[ts].dataType)) & (c < F.lit(end).cast(df.schema[ts].dataType)))


def week_start(d: Column, anchor: str = "2024-01-01") -> Column:
    """Start of the 7-day window containing ``d``, counting windows from ``anchor``."""
    a = F.lit(anchor).cast("date")
    return F.date_sub(d, F.pmod(F.datediff(d, a), F.lit(7)))


def with_landing_keys(df: DataFrame, ts: str, anchor: str = "2024-01-01") -> DataFrame:
    d = F.to_date(F.col(ts))
    return df.withColumn("year", F.year(d)).withColumn("month", F.month(d)).withColumn("week_starting", week_start(d, anchor))


def land(df: DataFrame, root: str, ts: str, anchor: str = "2024-01-01", mode: str = "overwrite") -> None:
    """Write a raw slice under ``year=/month=/week_starting=`` partitions.

    Rows are range-partitioned by their timestamp first: ranges follow the
    data, so a busy week is split over as many tasks as it needs while a task
    still writes to few partitions. With ``partitionOverwriteMode=dynamic`` a
    re-landed week replaces only its own partitions.
    """
    keyed = with_landing_keys(df, ts, anchor).repartitionByRange(ts)
    keyed.write.mode(mode).partitionBy("year", "month", "week_starting").parquet(root)


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    df = spark.read.option("basePath", root).parquet(root)
    return df.withColumn("year", F.col("year").cast("int")).withColumn("month", F.col("month").cast("int")).withColumn(
        "week_starting", F.col("week_starting").cast("date")
    )


def with_quarter(df: DataFrame, ts: str, name: str = "quarter") -> DataFrame:
    """Calendar quarter (1-4) of the timestamp's month."""
    return df.withColumn(name, F.quarter(F.col(ts)).cast("bigint"))


def _cuts_below(cuts: list, field: StructField) -> Column:
    """How many of the cut points a column has reached; 0 for null."""
    if not cuts:
        return F.lit(0)
    held = F.array(*[F.lit(v) for v in cuts]).cast(ArrayType(field.dataType))
    below = F.size(F.filter(held, lambda cut: cut <= F.col(field.name)))
    return F.when(F.col(field.name).isNull(), 0).otherwise(below)


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 8, sample: int = 20_000) -> Column:
    """Interleaved bits of the columns' ranks, so that near keys are near in every column.

    A value's rank is the number of cut points below it; the cuts are even
    quantiles of a sample of ``sample`` rows at most (those with the smallest
    hash), which is all that reaches the driver. They decide about the layout
    only. Nulls come first.
    """
    some = df.select(*columns).orderBy(F.xxhash64(*columns)).limit(sample).collect()
    ranks = []
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in some if r[i] is not None)
        cuts = sorted({values[len(values) * q >> bits] for q in range(1, 1 << bits)}) if values else []
        ranks.append(_cuts_below(cuts, df.schema[c]))
    key = F.lit(0).cast("bigint")
    for b in range(bits):
        for i, r in enumerate(ranks):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("bigint"), b * len(columns) + i))
    return key


def write_zorder(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Write a table in files along the columns' Z-order: filters on any of them skip files by their statistics."""
    keyed = df.withColumn("_z", zorder_key(df, columns))
    dealt = keyed.repartitionByRange(files, "_z") if files else keyed.repartitionByRange("_z")
    dealt.sortWithinPartitions("_z").drop("_z").write.mode("overwrite").parquet(path)


def write_gold(df: DataFrame, path: str, cluster_by: Sequence[str], mode: str = "overwrite", schema: StructType | None = None) -> None:
    """Materialise a gold table range-clustered on ``cluster_by``, after its contract (``schema``) has been checked.

    ``repartitionByRange`` + ``sortWithinPartitions`` give each file a narrow
    min/max range per key, so Parquet row-group statistics skip files for
    filters on the leading cluster columns.
    """
    cols = list(cluster_by)
    if schema is not None:
        contract_gold(df, schema)
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.mode(mode).parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
