"""Marts kept up to date from the changes of a versioned fact table.

Each derived table is versioned, too, and its marker notes the version of its
source that it reflects. A refresh asks the source which partitions changed
since then, reads those alone, and commits; a refresh that failed is simply run
again, and several loads can be caught up at once.

- Station months are sums and counts, so a change is their difference: the
  changed partitions' sums as they are now less those as they were
  (:func:`refresh_months`). Names are part of the grain with their row counts,
  since a maximum cannot be taken back; a line without rows goes.
- Recovery compares a station's months with its own baseline, so stations whose
  months changed are worked out anew from the (small) station months
  (:func:`refresh_recovery`).
- Congestion compares an hour with its station's day and with the system's hour,
  both of one date, so changed dates are worked out anew (:func:`refresh_congestion`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import initcap_words
from stationflow.operators.congestion import congestion_hourly, fare_consolidated
from stationflow.operators.recovery import monthly_columns, recovery_from_monthly
from stationflow.session import materialize
from stationflow.streaming.versions import VersionConflict, VersionedTable, only

BUCKETS = 64  # parts of the station-keyed tables
FACT_KEY = ["station_complex_id", "transit_timestamp", "fare_class", "payment_method"]
MONTH_KEYS = ["station_complex_id", "transit_year", "transit_month"]
NAMES = ["station_name", "borough"]
SUMS = {"_r": ("ridership", "decimal(18,2)", "decimal(28,2)"), "_lat": ("latitude", "decimal(12,6)", "decimal(22,6)"), "_lon": ("longitude", "decimal(12,6)", "decimal(22,6)")}
COUNTS = {"_nlat": "latitude", "_nlon": "longitude"}
PARTS = [*SUMS, *COUNTS, "_rows"]


def bucket(station: str = "station_complex_id", buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64(station), F.lit(buckets)).cast("int")


def consolidated(stg: DataFrame) -> DataFrame:
    """Staged rows at the source's own grain, one for each station, time, fare class and payment method, with its month."""
    attrs = [F.max(c).alias(c) for c in (*NAMES, "latitude", "longitude", "transit_date", "transit_hour", "transit_year", "transit_month")]
    total = F.sum(F.col("ridership").cast("decimal(18,2)")).cast("double").alias("ridership")
    return stg.groupBy(*FACT_KEY).agg(*attrs, total).withColumn("month", F.trunc("transit_date", "month"))


def month_parts(rows: DataFrame) -> DataFrame:
    """Sums and counts of each station, year, month and spelling of the names."""
    sums = [F.sum(F.col(c).cast(t)).cast(to).alias(o) for o, (c, t, to) in SUMS.items()]
    counts = [F.count(F.col(c)).alias(o) for o, c in COUNTS.items()]
    return rows.groupBy(*MONTH_KEYS, *NAMES).agg(*sums, *counts, F.count(F.lit(1)).alias("_rows"))


def add_parts(parts: DataFrame) -> DataFrame:
    """Parts added up; what has no rows left goes."""
    types = {o: to for o, (_, _, to) in SUMS.items()}
    added = [F.sum(c).cast(types.get(c, "bigint")).alias(c) for c in PARTS]
    return parts.groupBy(*MONTH_KEYS, *NAMES).agg(*added).filter(F.col("_rows") > 0)


def monthly_from_parts(parts: DataFrame) -> DataFrame:
    """:func:`recovery.monthly_totals` from the parts."""
    names = [F.max(initcap_words(F.col(c))).alias(c) for c in NAMES]
    return monthly_columns(parts.groupBy(*MONTH_KEYS).agg(*names, *[F.sum(c).alias(c) for c in PARTS]))


def _since(source: VersionedTable, derived: VersionedTable) -> tuple[int, int]:
    """The source's version that the derived table reflects, and the newest."""
    return derived.meta().get("source", 0), source.version()


def _commit(derived: VersionedTable, rows: DataFrame, touched: DataFrame, source: int) -> int:
    version = derived.commit(rows, touched, derived.version(), {"source": source})
    if not version:
        raise VersionConflict(f"{derived.root}: another refresh has been at work; run it again")
    return version


def month_changes(facts: VersionedTable, since: int, until: int) -> DataFrame:
    """What to add to the station months: sums of the changed partitions now, less those before; lines that stay as they are left out."""
    changed = materialize(facts.changed(since, until), "changed")
    now = month_parts(facts.read(until, changed))
    if since:
        before = month_parts(facts.read(since, changed))
        now = now.unionByName(before.withColumns({c: -F.col(c) for c in PARTS}))
    added = [F.sum(c).cast(now.schema[c].dataType).alias(c) for c in PARTS]
    differs = F.lit(False)
    for c in PARTS:
        differs = differs | (F.col(c) != 0)
    return now.groupBy(*MONTH_KEYS, *NAMES).agg(*added).filter(differs)


def refresh_months(facts: VersionedTable, months: VersionedTable) -> int:
    """Bring the station months (partitioned by ``bucket``) up to the newest facts; returns their version."""
    since, until = _since(facts, months)
    if since == until:
        return months.version()
    change = materialize(month_changes(facts, since, until).withColumn("bucket", bucket()), "month-changes")
    touched = change.select("bucket").distinct()
    held = months.read(partitions=touched)
    parts = change if held is None else held.unionByName(change)
    return _commit(months, add_parts(parts).withColumn("bucket", bucket()), touched, until)


def refresh_recovery(months: VersionedTable, recovery: VersionedTable, **options) -> int:
    """Bring the recovery mart (partitioned by ``bucket``) up to the newest station months; returns its version."""
    since, until = _since(months, recovery)
    if since == until:
        return recovery.version()
    touched = materialize(months.changed(since, until), "changed")
    rows = recovery_from_monthly(monthly_from_parts(months.read(until, touched)), **options)
    return _commit(recovery, rows.withColumn("bucket", bucket()), touched, until)


def refresh_congestion(facts: VersionedTable, mart: VersionedTable, **options) -> int:
    """Bring the congestion mart (partitioned by date, as the facts are) up to the newest facts; returns its version."""
    since, until = _since(facts, mart)
    if since == until:
        return mart.version()
    touched = materialize(facts.changed(since, until), "changed")
    rows = congestion_hourly(fare_consolidated(facts.read(until, touched)), **options)
    return _commit(mart, only(rows, touched, [mart.partition_col]), touched, until)
