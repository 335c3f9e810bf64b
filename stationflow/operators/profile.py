"""Distribution profiles (exploratory quantiles) as single grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import dec_avg, rnd
from stationflow.operators.common import exact_quantiles

DEFAULT_QS = (0.25, 0.5, 0.75, 0.95, 0.99, 0.999)


def _qname(q: float) -> str:
    return "p" + f"{q * 100:g}".replace(".", "")


def quantile_profile(df: DataFrame, col: str, qs: Sequence[float] = DEFAULT_QS, digits: int = 4, approx: bool = False) -> DataFrame:
    """Exact (interpolated) quantiles of the non-NULL values plus the max, one row.

    Exact ones come from :func:`exact_quantiles`, whose values stay spread over
    the cluster; ``approx=True`` switches to ``percentile_approx``, one
    bounded sketch. An input without values gives no row (one row of NULLs
    with ``approx``).
    """
    x = F.col(col)
    if not approx:
        g = exact_quantiles(df, [], col, qs)
        return g.select(*[rnd(F.col(f"q{i}"), digits).alias(_qname(q)) for i, q in enumerate(qs)], "max_value", "n")
    arr = F.percentile_approx(x, list(qs), 100000)
    g = df.filter(x.isNotNull()).agg(arr.alias("_q"), F.max(x).alias("max_value"), F.count(x).alias("n"))
    return g.select(
        *[rnd(F.get(F.col("_q"), i), digits).alias(_qname(q)) for i, q in enumerate(qs)],
        "max_value",
        "n",
    )


def income_profile(df: DataFrame, col: str = "median_household_income") -> DataFrame:
    """Quartiles (the lower one, elements of the column), mean, min and max of the non-NULL values.

    The quartiles come from counted values (:func:`exact_quantiles`): no task
    holds the table's values. An input without values gives one row of NULLs.
    """
    x = F.col(col)
    names = [f"q{i}" for i in range(5)]
    qs = exact_quantiles(df, [], col, (0.0, 0.25, 0.5, 0.75, 1.0), disc=True).select(*names)
    rest = df.agg(rnd(dec_avg(col), 2).alias("mean_income"), F.min(x).alias("min_income"), F.max(x).alias("max_income"))
    # both sides are one row at most
    one = lambda c: F.pmod(F.hash(c), F.lit(1)).alias("_one")  # noqa: E731  a key that the optimiser does not see through
    return rest.select("*", one("min_income")).join(F.broadcast(qs.select("*", one("q0"))), "_one", "left").select(*names, "mean_income", "min_income", "max_income")
