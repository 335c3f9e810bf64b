"""Plan inspection helpers for tests and reviews (reads ``explain`` text only)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Physical operators a scalable plan here must not contain.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of an operator in the (initial, pre-AQE) physical plan tree."""
    tree = plan_text(df, "formatted").split("\n\n")[0]
    return len(re.findall(rf"\b{name}\b", tree))


def forbidden_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "formatted")
    return [n for n in FORBIDDEN if n in text]
