"""Aggregation patterns shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rollup_with_attrs(
    df: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    sums: Mapping[str, tuple[str, int, int]] = {},
    counts: Mapping[str, str] = {},
    attr_fn: Callable[[Column], Column] | None = None,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Group by ``keys`` with descriptive string ``attrs`` taken as ``max``.

    ``max`` of a string cannot live in a hash-aggregate buffer, so a single
    ``groupBy(keys).agg(max(name))`` plans a sort-based aggregate over every
    input row. Instead the first level groups by keys + attrs (strings as hash
    keys, with map-side partial aggregation) and the second level, on the
    already reduced rows, takes ``max`` of the attrs and re-adds the partial
    sums and counts. ``sums`` maps output -> (column, precision, scale), summed
    exactly as DECIMAL; ``counts`` maps output -> column (non-null count).
    Outputs stay DECIMAL / BIGINT; callers cast at the end. ``attr_fn`` (for
    example name normalisation) is applied to the attrs at the second level,
    i.e. once per distinct spelling instead of once per input row.

    ``partition_by`` (a subset of ``keys``) hash-partitions the reduced first
    level on those columns: the second level and any later window or
    aggregate clustered on them then need no further shuffle.
    """
    lvl1 = [F.sum(F.col(c).cast(f"decimal({p},{s})")).alias(o) for o, (c, p, s) in sums.items()]
    lvl1 += [F.count(F.col(c)).alias(o) for o, c in counts.items()]
    first = df.groupBy(*keys, *attrs).agg(*lvl1) if lvl1 else df.groupBy(*keys, *attrs).count()
    if partition_by:
        first = first.repartition(*partition_by)
    fn = attr_fn or (lambda c: c)
    lvl2 = [F.max(fn(F.col(a))).alias(a) for a in attrs]
    lvl2 += [F.sum(o).alias(o) for o in sums]
    lvl2 += [F.sum(o).alias(o) for o in counts]
    return first.groupBy(*keys).agg(*lvl2)


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, a null key being equal to a null key."""
    names = {k: f"_same_{k}" for k in keys}
    other = right.withColumnsRenamed(names)
    on = [left[k].eqNullSafe(other[n]) for k, n in names.items()]
    return left.join(other, on, how).drop(*names.values())


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, qs: Sequence[float], parts: int = 64, disc: bool = False) -> DataFrame:
    """Exact interpolated quantiles of the non-NULL values of each key: (keys, n, max_value, q0, q1, ...).

    ``disc=True`` gives the smallest value whose cumulative share reaches the
    quantile (an element, in the column's own type) instead. A null key is a
    key of its own.

    No buffer or task holds a key's values. Values are counted first (copies
    collapse map-side), each key's distinct values are cut into ``parts``
    ordered parts at approximate quantiles, ranks come from the parts' sums,
    and running counts inside a part. Without ``keys`` the table is one key.
    """
    by = list(keys) or ["_all"]
    # without keys: one key that the optimiser does not see through, and small sides of one and of ``parts`` rows
    src = df if keys else df.withColumn("_all", F.pmod(F.hash(col), F.lit(1)))
    small = (lambda x: x) if keys else F.broadcast
    counts = src.filter(F.col(col).isNotNull()).groupBy(*by, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    cuts = counts.groupBy(*by).agg(F.percentile_approx("_v", [i / parts for i in range(1, parts)], 10 * parts).alias("_cuts"))
    placed = join_same(counts, small(cuts), by).withColumn("_part", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    sums = placed.groupBy(*by, "_part").agg(F.sum("_n").alias("_s"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "_part", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"), F.sum("_s").over(Window.partitionBy(*by)).alias("_total"))
    inside = Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_same(placed, small(sums), [*by, "_part"]).withColumn("_end", F.col("_base") + F.sum("_n").over(inside))
    begin = F.col("_end") - F.col("_n")

    def at(rank):
        return F.max(F.when((begin <= rank) & (rank < F.col("_end")), F.col("_v") if disc else F.col("_v").cast("double")))

    aggs = [F.max("_total").alias("n"), F.max("_v").alias("max_value")]
    if disc:
        aggs += [at(F.greatest(F.ceil(F.lit(float(q)) * F.col("_total")) - 1, F.lit(0))).alias(f"q{i}") for i, q in enumerate(qs)]
        return ranked.groupBy(*by).agg(*aggs).select(*keys, "n", "max_value", *[f"q{i}" for i in range(len(qs))])
    for i, q in enumerate(qs):
        place = F.lit(float(q)) * (F.col("_total") - 1).cast("double")
        aggs += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}")]
    g = ranked.groupBy(*by).agg(*aggs)
    place = [F.lit(float(q)) * (F.col("n") - 1).cast("double") for q in qs]
    value = [
        F.when(F.floor(p) == F.ceil(p), F.col(f"_lo{i}")).otherwise((F.ceil(p) - p) * F.col(f"_lo{i}") + (p - F.floor(p)) * F.col(f"_hi{i}"))
        for i, p in enumerate(place)
    ]
    return g.select(*keys, "n", "max_value", *[v.alias(f"q{i}") for i, v in enumerate(value)])
