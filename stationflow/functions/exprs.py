"""Column expressions shared by every operator.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen (no Python UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


EXACT_DOUBLE = float(2**53)  # doubles from here on are whole numbers


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x, n: int) -> Column:
    """Half-away-from-zero rounding to ``n`` decimals on doubles.

    Written as ``signum(x) * floor(|x| * 10^n + 0.5) / 10^n`` so that the
    same IEEE steps run in Spark and in the DuckDB oracle (``round`` ties
    differ between engines). From ``|x| * 10^n >= 2^53`` on a double has no
    digits behind the ``n``-th decimal, so x itself is the result (``floor``
    is a bigint and would saturate).
    """
    x = _c(x).cast("double")
    scale = float(10**n)
    rounded = F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.abs(x) * F.lit(scale) >= F.lit(EXACT_DOUBLE), x).otherwise(rounded)


def safe_div(a, b) -> Column:
    """NULL when the denominator is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def dec_sum(x, precision: int = 18, scale: int = 2) -> Column:
    """Order-independent sum of money-like doubles: sum as DECIMAL, emit double."""
    return F.sum(_c(x).cast(f"decimal({precision},{scale})")).cast("double")


def dec_avg(x, precision: int = 18, scale: int = 2) -> Column:
    """Average as exact decimal sum / count, emitted as double."""
    return F.try_divide(
        F.sum(_c(x).cast(f"decimal({precision},{scale})")).cast("double"),
        F.count(_c(x)).cast("double"),
    )


def null_least(*cols) -> Column:
    """LEAST that returns NULL when any input is NULL (warehouse semantics)."""
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def null_greatest(*cols) -> Column:
    """GREATEST that returns NULL when any input is NULL (warehouse semantics)."""
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


# The word delimiters of the warehouse INITCAP function
# (whitespace plus these characters), which must match for equal names.
INITCAP_DELIMITERS = " [ ] ( ) { } / | \\ < > ! ? @ \" ^ # $ & ~ _ , . : ; * % + -"


def initcap_class() -> str:
    """Regex character class of the INITCAP delimiters (Java regex and RE2)."""
    chars = [c for c in INITCAP_DELIMITERS.split(" ") if c]
    escaped = "".join("\\" + c if c in "[]\\^-" else c for c in chars)
    return "[\\s" + escaped + "]"


def initcap_words(x) -> Column:
    """Punctuation-aware INITCAP: upper-case the first letter after any delimiter.

    ``'174-175 STS (B,D)'`` -> ``'174-175 Sts (B,D)'``. Spark's ``initcap``
    only starts words after a space, so a space is inserted after every
    delimiter, ``initcap`` runs (codegen, no lambda), and exactly one space
    after each delimiter is removed again.
    """
    cls = initcap_class()
    spaced = F.regexp_replace(_c(x), F.lit(f"({cls})"), F.lit("$1 "))
    return F.regexp_replace(F.initcap(spaced), F.lit(f"({cls}) "), F.lit("$1"))


def season(month) -> Column:
    """Meteorological season of a month number."""
    m = _c(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


_ELSE = "__else__"


def _tiered(x, levels, else_, null_label, op) -> Column:
    x = _c(x)
    expr = None
    if null_label != _ELSE:
        expr = F.when(x.isNull(), F.lit(null_label).cast("string"))
    for t, label in levels:
        cond = op(x, F.lit(t))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(else_)


def tier(x, levels: Sequence[tuple[float, str]], else_: str, null_label: str | None = _ELSE) -> Column:
    """Descending threshold tiers: the first ``x >= t`` wins.

    ``null_label`` left at its default reproduces SQL CASE (NULL falls into
    ELSE); ``None`` keeps NULL; any other string labels NULL explicitly.
    """
    return _tiered(x, levels, else_, null_label, lambda a, b: a >= b)


def below_tier(x, levels: Sequence[tuple[float, str]], else_: str, null_label: str | None = _ELSE) -> Column:
    """Ascending threshold tiers: the first ``x < t`` wins (income tiers)."""
    return _tiered(x, levels, else_, null_label, lambda a, b: a < b)


def hour_bucket(hour, am: tuple[int, int] = (5, 12), pm: tuple[int, int] = (13, 20)) -> Column:
    """Three-bucket time of day used by capacity benchmarks."""
    h = _c(hour)
    return F.when(h.between(*am), "AM").when(h.between(*pm), "PM").otherwise("Late Night")
