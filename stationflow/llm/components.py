"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a component of any size is
spread over the cluster; each round is written to the shared folder, which cuts
the lineage. Nothing but one row of totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (vertex, component): the smallest vertex reachable.

    Only vertices that have a link to another vertex are returned; null ends
    and links of a vertex to itself are ignored.
    """
    now = materialize(links.filter("a != b").select("a", "b"), "links")
    state = _state(now)
    while True:
        now = materialize(_small_star(_large_star(now)), "links")
        new = _state(now)
        if new == state:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        state = new
