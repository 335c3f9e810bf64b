"""Crosswalks whose links hold for a time and follow each other in chains.

A link ``(old_id, new_id, share, valid_from, valid_to)`` says that what the old
id counts on a day in ``[valid_from, valid_to)`` belongs, by ``share``, to the
new id (null bounds: open; null share: 1). Ids may be renamed again and again,
at other dates, so one reading can pass several links.

:func:`crosswalk_periods` resolves the links alone, which are few: each id's
time is cut where its links change, and paths are joined with paths (old to
newer with newer to newest, over the days both hold), so that lengths double
and a chain of ``n`` links takes ``log2(n)`` joins. :func:`rekey_days` then
meets each reading's day with one period by an equi-join on (id, time bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions import initcap_words, rnd, safe_div
from stationflow.operators.common import rollup_with_attrs
from stationflow.session import materialize

FIRST, LAST = "0001-01-01", "9999-12-31"
SHARE = "decimal(20,18)"
BUCKET_DAYS = 512


def _cut(rows: DataFrame, *more: Column) -> DataFrame:
    """(old_id, lo, hi): each id's time between neighbouring bounds of its rows."""
    bounds = rows.select("old_id", F.explode(F.array("lo", "hi", *more)).alias("lo")).distinct()
    ahead = F.lead("lo").over(Window.partitionBy("old_id").orderBy("lo"))
    return bounds.select("old_id", "lo", ahead.alias("hi")).filter("hi is not null")


def _on(pieces: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` on each piece of their id's time that they hold; a piece without rows once, with nulls."""
    r = rows.select(F.col("old_id").alias("_id"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), *[c for c in rows.columns if c not in ("old_id", "lo", "hi")])
    held = (pieces.old_id == r["_id"]) & (r["_lo"] <= pieces.lo) & (pieces.hi <= r["_hi"])
    return pieces.join(r, held, "left").drop("_id", "_lo", "_hi")


def _steps(crosswalk: DataFrame) -> DataFrame:
    """(old_id, lo, hi, end, share, done): where each id goes by one link at any time.

    A link to itself keeps its share (done), and so does an id while no link holds.
    """
    day = lambda c, other: F.coalesce(F.col(c).cast("date"), F.lit(other).cast("date"))
    links = crosswalk.select(
        F.col("old_id").cast("string").alias("old_id"), day("valid_from", FIRST).alias("lo"), day("valid_to", LAST).alias("hi"),
        F.col("new_id").cast("string").alias("end"), F.coalesce(F.col("share"), F.lit(1)).cast(SHARE).alias("share"),
    ).filter("old_id is not null and end is not null and lo < hi and share <> 0")
    whole = [F.lit(b).cast("date") for b in (FIRST, LAST)]
    on = _on(_cut(links, *whole), links)
    steps = on.select(
        "old_id", "lo", "hi", F.coalesce("end", "old_id").alias("end"), F.coalesce("share", F.lit(1).cast(SHARE)).alias("share"),
        (F.col("end").isNull() | (F.col("end") == F.col("old_id"))).alias("done"),
    )
    return _added(steps)


def _added(paths: DataFrame) -> DataFrame:
    """Paths with the same ends and days as one."""
    return paths.groupBy("old_id", "lo", "hi", "end", "done").agg(F.sum("share").cast(SHARE).alias("share"))


def _doubled(paths: DataFrame) -> DataFrame:
    """Open paths go on by the paths of the id they have reached, on the days that both hold."""
    ahead = paths.toDF(*[f"_{c}" for c in paths.columns])
    meet = (F.col("end") == F.col("_old_id")) & (F.col("lo") < F.col("_hi")) & (F.col("_lo") < F.col("hi"))
    on = paths.filter("not done").join(ahead, meet, "left").select(
        "old_id", F.greatest("lo", "_lo").alias("lo"), F.least("hi", "_hi").alias("hi"), F.coalesce("_end", "end").alias("end"),
        F.coalesce("_done", F.lit(True)).alias("done"),  # an id without links is the newest
        F.coalesce((F.col("share") * F.col("_share")).cast(SHARE), F.col("share")).alias("share"),
    )
    columns = ["old_id", "lo", "hi", "end", "done", "share"]
    return _added(paths.filter("done").select(*columns).unionAll(on.select(*columns)))


def crosswalk_periods(crosswalk: DataFrame) -> DataFrame:
    """(old_id, new_id, share, valid_from, valid_to, on_cycle): the newest ids of each old id, period by period.

    Days on which an id's chain runs into a cycle have no newest id: the id
    keeps all of it then (one row, ``on_cycle``). Days without a row: the id is
    its own newest. Periods are maximal and those of one (old, new) do not overlap.
    """
    paths = materialize(_steps(crosswalk), "crosswalk-paths")
    longest = max(1, paths.select("old_id").distinct().count())  # links of a chain that is no cycle
    reached = 1
    while not paths.filter("not done").isEmpty() and reached < longest + 1:
        paths = materialize(_doubled(paths), "crosswalk-paths")
        reached *= 2
    on = _on(_cut(paths), paths)
    piece = Window.partitionBy("old_id", "lo")
    on = on.withColumn("on_cycle", F.max(~F.col("done")).over(piece))
    kept = on.select(
        "old_id", "lo", "hi", "on_cycle", F.when(F.col("on_cycle"), F.col("old_id")).otherwise(F.col("end")).alias("new_id"),
        F.when(F.col("on_cycle"), F.lit(1).cast(SHARE)).otherwise(F.col("share")).alias("share"),
    )
    cyclic = kept.filter("on_cycle").distinct()
    fine = kept.filter("not on_cycle").groupBy("old_id", "lo", "hi", "on_cycle", "new_id").agg(F.sum("share").cast(SHARE).alias("share"))
    fine = fine.withColumn("_ends", F.count(F.lit(1)).over(piece)).filter("not (new_id = old_id and share = 1 and _ends = 1)").drop("_ends")
    same = Window.partitionBy("old_id", "new_id", "share", "on_cycle").orderBy("lo")
    rows = cyclic.select(*fine.columns).unionAll(fine).withColumn("_new", (~F.lag("hi").over(same).eqNullSafe(F.col("lo"))).cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(same))
    out = rows.groupBy("old_id", "new_id", "share", "on_cycle", "_run").agg(F.min("lo").alias("valid_from"), F.max("hi").alias("valid_to"))
    return out.select("old_id", "new_id", "share", "valid_from", "valid_to", "on_cycle")


def crosswalk_faults(periods: DataFrame, digits: int = 6) -> DataFrame:
    """(old_id, valid_from, valid_to, fault, share): days on a cycle, and days whose shares do not add up to 1.

    ``share`` is the sum of the day's shares, to ``digits`` decimals.
    """
    p = periods.withColumnsRenamed({"valid_from": "lo", "valid_to": "hi"})
    on = _on(_cut(p), p).filter("share is not null")
    sums = on.groupBy("old_id", "lo", "hi").agg(F.max("on_cycle").alias("on_cycle"), F.sum("share").alias("share"))
    sums = sums.select("old_id", "lo", "hi", F.when(F.col("on_cycle"), "cycle").otherwise("share").alias("fault"), rnd("share", digits).alias("share"))
    sums = sums.filter("fault = 'cycle' or share <> 1")
    same = Window.partitionBy("old_id", "fault", "share").orderBy("lo")
    runs = sums.withColumn("_new", (~F.lag("hi").over(same).eqNullSafe(F.col("lo"))).cast("int")).withColumn("_run", F.sum("_new").over(same))
    out = runs.groupBy("old_id", "fault", "share", "_run").agg(F.min("lo").alias("valid_from"), F.max("hi").alias("valid_to"))
    return out.select("old_id", "valid_from", "valid_to", "fault", "share")


def rekey_days(days: DataFrame, periods: DataFrame, id_col: str, date_col: str, amount: str, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """``days`` under their newest ids: ``id_col`` becomes the new id, ``old_id`` keeps the old, ``amount`` is the part in cents.

    A row of the input is one (id, day); the cents that rounding leaves over go
    to the parts in id order, so the parts of a row add up to its amount times
    the sum of its shares. The join is on (id, bucket of days), which also
    splits the rows of a hot id; periods are cut to the days at hand, so an open
    period has as many buckets as the data.
    """
    span = days.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))  # one row
    lo, hi = span.first()
    if lo is None:
        return days.withColumn("old_id", F.col(id_col)).withColumn(amount, F.col(amount).cast("decimal(18,2)"))
    bucket = lambda c: F.floor(F.unix_date(c) / bucket_days).cast("int")
    p = periods.filter((F.col("valid_from") <= F.lit(hi)) & (F.col("valid_to") > F.lit(lo)))
    last = F.least(F.date_sub("valid_to", 1), F.lit(hi))
    p = p.select("old_id", "new_id", "share", "valid_from", "valid_to", F.explode(F.sequence(bucket(F.greatest("valid_from", F.lit(lo))), bucket(last))).alias("_pb"))
    on = (days[id_col] == p.old_id) & (bucket(days[date_col]) == p["_pb"]) & (days[date_col] >= p.valid_from) & (days[date_col] < p.valid_to)
    j = days.join(p, on, "left")
    up_to = Window.partitionBy(id_col, date_col).orderBy("new_id")
    share = F.coalesce("share", F.lit(1).cast(SHARE))
    running = F.sum(share).over(up_to.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(18,9)")
    before = F.coalesce(F.sum(share).over(up_to.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(18,9)")
    whole = F.col(amount).cast("decimal(18,2)")
    j = j.withColumn("_part", (F.round(whole * running, 2) - F.round(whole * before, 2)).cast("decimal(18,2)"))
    others = [c for c in days.columns if c not in (id_col, amount)]
    return j.select(F.coalesce("new_id", id_col).alias(id_col), F.col(id_col).alias("old_id"), *others, F.col("_part").alias(amount))


def rekeyed_monthly(stg: DataFrame, periods: DataFrame) -> DataFrame:
    """Station months (the columns of ``monthly_totals``) under the newest ids, each day by the links of that day.

    A station's name, borough and place are its own where it has readings of
    its own in the month, else those of the ids it continues.
    """
    sums = {"_sum": ("ridership", 18, 2), "_lat": ("latitude", 12, 6), "_lon": ("longitude", 12, 6)}
    counts = {"_nlat": "latitude", "_nlon": "longitude"}
    days = rollup_with_attrs(stg, ["station_complex_id", "transit_date"], ["station_name", "borough"], sums, counts, attr_fn=initcap_words)
    keyed = rekey_days(days, periods, "station_complex_id", "transit_date", "_sum")
    keyed = keyed.withColumns({"ridership_month_date": F.trunc("transit_date", "month"), "_own": F.col("old_id") == F.col("station_complex_id")})
    parts = [F.sum(c).alias(c) for c in ("_sum", "_lat", "_lon", "_nlat", "_nlon")]
    by_name = keyed.groupBy("station_complex_id", "ridership_month_date", "_own", "station_name", "borough").agg(*parts)
    own = lambda c: F.coalesce(F.max(F.when(F.col("_own"), F.col(c))), F.max(c)).alias(c)

    def mean(s: str, n: str) -> Column:
        of = lambda c: F.coalesce(F.sum(F.when(F.col("_own"), F.col(c))), F.sum(c))
        return rnd(safe_div(of(s), of(n)), 6)

    g = by_name.groupBy("station_complex_id", "ridership_month_date").agg(
        own("station_name"), own("borough"), mean("_lat", "_nlat").alias("latitude"), mean("_lon", "_nlon").alias("longitude"),
        F.sum("_sum").cast("double").alias("monthly_ridership"),
    )
    return g.select(
        "station_complex_id", "station_name", "borough", "latitude", "longitude", F.year("ridership_month_date").cast("bigint").alias("ridership_year"),
        F.month("ridership_month_date").cast("bigint").alias("ridership_month"), "ridership_month_date", "monthly_ridership",
    )
