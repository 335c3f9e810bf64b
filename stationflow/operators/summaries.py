"""Stored summaries that merge to any grain: quantiles and frequent values without the rows.

A summary is a plain table, a few rows for each key (say, station and day),
made once from the rows. A coarser grain is made from the finer one's summary,
step by step, so each step meets few rows of a key. Both kinds are
deterministic (no random choices, no order of arrival) and state their error.

Quantile points ``(keys, v, w)``: ``w`` values, the largest of them ``v``. A
step of ``size`` cells keeps at most ``2 * size`` rows for a key and moves the
rank of any value down by less than ``1 / size`` of the key's values; values
that make up that share by themselves stay apart and exact. After ``steps``
steps, the value read for ``q`` is an exact quantile of some share between
``q`` and ``q + steps / size``.

Frequent values ``(keys, value, n, miss, cut)``: ``value`` occurs at least
``n`` and at most ``n + miss`` times, and values that are not listed at most
``cut`` times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quantile_points(rows: DataFrame, keys: Sequence[str], col: str, size: int = 200) -> DataFrame:
    """The summary of the non-NULL values of each key; a null key is a key of its own. One step."""
    return _cells(rows.filter(F.col(col).isNotNull()).select(*keys, F.col(col).alias("v"), F.lit(1).cast("bigint").alias("w")), keys, size)


def merge_points(points: DataFrame, keys: Sequence[str], size: int = 200) -> DataFrame:
    """The summary at a coarser grain, from a finer one's. One step more."""
    return _cells(points.select(*keys, "v", "w"), keys, size)


def _cells(points: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    by = Window.partitionBy(*keys)
    counted = points.groupBy(*keys, "v").agg(F.sum("w").alias("w"))
    ranked = counted.select("*", F.sum("w").over(by.orderBy("v")).alias("_end"), F.sum("w").over(by).alias("_n"))
    heavy = F.col("w") * size >= F.col("_n")
    # a light value goes to the cell that it begins in: what begins there before the cell's last value is less than a cell
    cell = F.when(heavy, F.lit(-1)).otherwise(F.expr(f"((_end - w) * {int(size)}) div _n")).alias("_cell")
    apart = F.when(heavy, F.col("v")).alias("_apart")
    return ranked.groupBy(*keys, cell, apart).agg(F.max("v").alias("v"), F.sum("w").alias("w")).select(*keys, "v", "w")


def read_quantiles(points: DataFrame, keys: Sequence[str], qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(keys, n, names...): for each q the smallest ``v`` whose points reach the share q."""
    by = Window.partitionBy(*keys)
    ranked = points.groupBy(*keys, "v").agg(F.sum("w").alias("w")).select(
        *keys, "v", F.sum("w").over(by.orderBy("v")).alias("_end"), F.sum("w").over(by).alias("_n")
    )
    reach = [F.min(F.when(F.col("_end") >= F.lit(float(q)) * F.col("_n"), F.col("v"))).alias(name) for q, name in zip(qs, names, strict=True)]
    return ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *reach)


# ------------------------------------------------------------------ frequent values
def value_counts(rows: DataFrame, keys: Sequence[str], col: str, size: int = 8) -> DataFrame:
    """The ``size`` most frequent non-NULL values of each key (ties: the smaller), counted exactly."""
    zero = F.lit(0).cast("bigint")
    counted = rows.filter(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return _listed(counted.select("*", zero.alias("miss"), zero.alias("cut")), keys, size)


def merge_counts(counts: DataFrame, fine: Sequence[str], keys: Sequence[str], size: int = 8) -> DataFrame:
    """The summary at the grain ``keys`` from that at ``fine``, whose keys determine ``keys``.

    A key of ``fine`` that does not list a value may hide it up to its own
    ``cut``, so a value lacks at most what the keys that list it lack, and the
    cuts of all others.
    """
    hidden = counts.groupBy(*dict.fromkeys([*keys, *fine])).agg(F.max("cut").alias("cut")).groupBy(*keys).agg(F.sum("cut").alias("_all"))
    added = counts.groupBy(*keys, "value").agg(F.sum("n").alias("n"), F.sum("miss").alias("miss"), F.sum("cut").alias("_own"))
    same = {k: f"_h_{k}" for k in keys}
    other = hidden.withColumnsRenamed(same)
    j = added.join(other, [added[k].eqNullSafe(other[h]) for k, h in same.items()])
    return _listed(j.select(*keys, "value", "n", (F.col("miss") + F.col("_all") - F.col("_own")).alias("miss"), F.col("_all").alias("cut")), keys, size)


def _listed(counted: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    by = Window.partitionBy(*keys)
    placed = counted.withColumn("_at", F.row_number().over(by.orderBy(F.col("n").desc(), "value")))
    dropped = F.max(F.when(F.col("_at") > size, F.col("n") + F.col("miss"))).over(by)
    return placed.withColumn("cut", F.greatest("cut", dropped)).filter(F.col("_at") <= size).select(*keys, "value", "n", "miss", "cut")


def read_top_value(counts: DataFrame, keys: Sequence[str], out: str = "top_value") -> DataFrame:
    """(keys, ``out``, n_least, n_most, sure): the most frequent value (ties: the smallest) as far as the summary tells.

    ``sure``: no other value, listed or not, can be more frequent or win a tie.
    """
    by = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "value")
    placed = counts.select("*", F.row_number().over(by).alias("_at"), F.first("n").over(by).alias("_n"), F.first("value").over(by).alias("_v"))
    most = F.col("n") + F.col("miss")
    beaten = (F.col("_at") == 1) | (most < F.col("_n")) | ((most == F.col("_n")) & (F.col("value") > F.col("_v")))
    first = F.col("_at") == 1
    return placed.groupBy(*keys).agg(
        F.max(F.when(first, F.col("value"))).alias(out), F.max(F.when(first, F.col("n"))).alias("n_least"), F.max(F.when(first, most)).alias("n_most"),
        (F.bool_and(beaten) & (F.max("cut") < F.max("_n"))).alias("sure"),
    )
