"""Helpers for writing the DuckDB oracle SQL.

Each oracle query is a ``WITH`` chain assembled from named CTEs; a CTE lists
the CTEs it reads so that only what a query needs is emitted, in dependency
order. SQL helpers mirror ``stationflow.functions`` expression by expression
(same rounding steps, same NULL behaviour) so that values match bit for bit.
"""

from __future__ import annotations

from stationflow.functions.exprs import initcap_class


class CteRegistry:
    def __init__(self):
        self._ctes: dict[str, tuple[tuple[str, ...], str]] = {}

    def add(self, name: str, body: str, deps: tuple[str, ...] = ()) -> None:
        self._ctes[name] = (tuple(deps), body)

    def _order(self, names) -> list[str]:
        seen: list[str] = []

        def visit(n):
            if n in seen:
                return
            deps, _ = self._ctes[n]
            for d in deps:
                visit(d)
            seen.append(n)

        for n in names:
            visit(n)
        return seen

    def query(self, final: str, *needs: str) -> str:
        names = self._order(needs)
        if not names:
            return final.strip()
        parts = [f"{n} AS (\n{self._ctes[n][1].strip()}\n)" for n in names]
        return "WITH " + ",\n".join(parts) + "\n" + final.strip()


def rnd(x: str, n: int) -> str:
    scale = f"{float(10**n)!r}::DOUBLE"
    rounded = f"sign(({x})::DOUBLE) * floor(abs(({x})::DOUBLE) * {scale} + 0.5::DOUBLE) / {scale}"
    return f"(CASE WHEN abs(({x})::DOUBLE) * {scale} >= 9007199254740992::DOUBLE THEN ({x})::DOUBLE ELSE {rounded} END)"


def sdiv(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0.0::DOUBLE))"


def dsum(x: str, p: int = 18, s: int = 2) -> str:
    return f"CAST(sum(CAST(({x}) AS DECIMAL({p},{s}))) AS DOUBLE)"


def davg(x: str, p: int = 18, s: int = 2) -> str:
    return f"({dsum(x, p, s)} / nullif(CAST(count({x}) AS DOUBLE), 0.0::DOUBLE))"


def initcap(x: str) -> str:
    cls = initcap_class()
    inner = cls[1:-1]
    pat = f"{cls}+|[^{inner}]+"
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '{pat}'), "
        f"lambda t: upper(substr(t, 1, 1)) || substr(t, 2)), '')"
    )


def season(m: str) -> str:
    return (
        f"CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Spring' "
        f"WHEN {m} IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
    )


def tier(x: str, levels, else_: str, null_label: str | None = "__else__", op: str = ">=") -> str:
    parts = []
    if null_label != "__else__":
        parts.append(f"WHEN {x} IS NULL THEN " + ("NULL" if null_label is None else f"'{null_label}'"))
    for t, label in levels:
        parts.append(f"WHEN {x} {op} {t} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{else_}' END"


def bigint(x: str) -> str:
    return f"CAST({x} AS BIGINT)"
