"""Declarative data-quality checks and schema contracts.

Every check over a table is one aggregate pass (``count_if`` per rule),
returning a small result frame with one row per check; failing rows are
available from :func:`failing_rows` when the rows themselves are wanted.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "failures", "severity", "status"]


@dataclass(frozen=True)
class Check:
    """One rule: ``not_null``, ``unique``, ``accepted_values`` or ``expression`` (fails where true)."""

    kind: str
    column: str | tuple[str, ...]
    values: tuple = ()
    where: str | None = None
    fails_when: str | None = None
    severity: str = "error"
    name: str | None = field(default=None)

    @property
    def check_name(self) -> str:
        return self.name or self.kind

    @property
    def column_label(self) -> str:
        return ",".join(self.column) if isinstance(self.column, tuple) else self.column


def _scope(df: DataFrame, where: str | None) -> Column:
    return F.expr(where) if where else F.lit(True)


def _failure_expr(c: Check) -> Column:
    scope = _scope(None, c.where)
    if c.kind == "not_null":
        bad = F.col(c.column).isNull()
    elif c.kind == "accepted_values":
        bad = ~F.col(c.column).isin(list(c.values))  # NULL is not a failure, as in SQL NOT IN
    elif c.kind == "expression":
        bad = F.expr(c.fails_when)
    else:
        raise ValueError(c.kind)
    return F.count_if(scope & bad)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one table in one aggregate; unique checks as grouped counts."""
    row_checks = [c for c in checks if c.kind != "unique"]
    parts: list[DataFrame] = []
    if row_checks:
        agg = df.agg(*[_failure_expr(c).alias(f"c{i}") for i, c in enumerate(row_checks)])
        stack = ", ".join(
            f"'{c.check_name}', '{c.column_label}', '{c.severity}', c{i}" for i, c in enumerate(row_checks)
        )
        parts.append(
            agg.select(
                F.lit(table).alias("table_name"),
                F.expr(f"stack({len(row_checks)}, {stack}) AS (check_name, column_name, severity, failures)"),
            )
        )
    for c in checks:
        if c.kind == "unique":
            parts.append(dq_unique(df, list(c.column) if isinstance(c.column, tuple) else [c.column], table, c.severity).drop("status"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return out.select(
        "table_name", "check_name", "column_name", F.col("failures").cast("bigint").alias("failures"), "severity", status.alias("status")
    )


def dq_not_null(df: DataFrame, cols: Iterable[str], table: str = "table") -> DataFrame:
    return run_checks(df, table, [Check("not_null", c) for c in cols])


def dq_accepted_values(df: DataFrame, col: str, values: Sequence, table: str = "table", where: str | None = None, severity: str = "error") -> DataFrame:
    return run_checks(df, table, [Check("accepted_values", col, tuple(values), where=where, severity=severity)])


def dq_unique(df: DataFrame, key: list[str], table: str = "table", severity: str = "error") -> DataFrame:
    """Number of key values that occur more than once (one shuffle on the key)."""
    dup = df.groupBy(*key).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit("unique").alias("check_name"),
        F.lit(",".join(key)).alias("column_name"),
        F.lit(severity).alias("severity"),
        "failures",
    ).withColumn("status", F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))


def failing_rows(df: DataFrame, fails_when: str | Column, check: str) -> DataFrame:
    """Rows violating a rule (the singular-test form), tagged with the check name."""
    cond = F.expr(fails_when) if isinstance(fails_when, str) else fails_when
    return df.filter(cond).withColumn("check_name", F.lit(check))


def failing_rules(df: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows violating any of several rules (name -> (condition, column to show)), a row for each, in one pass."""
    broken = [
        F.when(F.expr(cond), F.struct(F.lit(name).alias("check_name"), F.col(col).cast("double").alias("detail")))
        for name, (cond, col) in rules.items()
    ]
    hits = F.filter(F.array(*broken), lambda r: r.isNotNull())
    return df.withColumn("_hit", F.explode(hits)).select("*", "_hit.check_name", "_hit.detail").drop("_hit")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL child keys with no parent row (anti join).

    Unlike ``NOT IN (subquery)``, a NULL among the parent keys does not hide
    every orphan.
    """
    c = child.select(key).filter(F.col(key).isNotNull()).distinct()
    p = parent.select(F.col(key).alias("_pk")).filter(F.col("_pk").isNotNull())
    return c.join(p, c[key] == p["_pk"], "left_anti")


def dq_report(tables: Mapping[str, tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """One row per check over every table (union of per-table aggregates)."""
    return reduce(lambda a, b: a.unionByName(b), [run_checks(df, name, checks) for name, (df, checks) in tables.items()])


# ------------------------------------------------------------------ contracts
class ContractViolation(ValueError):
    pass


@dataclass(frozen=True)
class ColumnContract:
    name: str
    dtype: str
    nullable: bool = True
    values: tuple | None = None
    min_value: float | None = None


def _violations(c: ColumnContract) -> dict[str, Column]:
    """The rules of a column, each true where a row breaks it (a NULL breaks the null rule alone)."""
    rules = {}
    if not c.nullable:
        rules["null"] = F.col(c.name).isNull()
    if c.values is not None:
        rules["domain"] = F.coalesce(~F.col(c.name).isin(list(c.values)), F.lit(False))
    if c.min_value is not None:
        rules["range"] = F.coalesce(F.col(c.name) < F.lit(c.min_value), F.lit(False))
    return rules


def contract_bronze(df: DataFrame, contract: Sequence[ColumnContract]) -> DataFrame:
    """Column-by-column contract result: presence, type, NULL, domain and range violations.

    Types are compared on the schema (no data read); all counts are one
    aggregate pass. A missing column reports NULL counts; a column that the
    contract does not name gets a row with a NULL ``type_ok``.
    """
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = ("null", "domain", "range")
    aggs, rows = [], []
    for i, c in enumerate(contract):
        present = c.name in fields
        rules = _violations(c) if present else {}
        for k in kinds:
            count = F.count_if(rules[k]) if k in rules else F.lit(0 if present else None).cast("bigint")
            aggs.append(count.alias(f"{k}{i}"))
        rows.append(f"'{c.name}', {str(present).lower()}, {str(present and fields[c.name] == c.dtype).lower()}, null{i}, domain{i}, range{i}")
    named = {c.name for c in contract}
    nothing = "CAST(NULL AS BIGINT)"
    rows += [f"'{n}', true, CAST(NULL AS BOOLEAN), {nothing}, {nothing}, {nothing}" for n in fields if n not in named]
    names = "column_name, present, type_ok, null_violations, domain_violations, range_violations"
    return df.agg(*aggs).select(F.expr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})"))


def contract_gate(df: DataFrame, contract: Sequence[ColumnContract]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and the others with their ``reject_reason`` (all broken rules, comma-joined).

    A missing column or a wrong type fails the whole load.
    """
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [c.name for c in contract if fields.get(c.name) != c.dtype]
    if wrong:
        raise ContractViolation(f"bronze contract mismatch: missing or of another type: {wrong}")
    reasons = [F.when(rule, F.lit(f"{c.name}:{k}")) for c in contract for k, rule in _violations(c).items()]
    reason = F.concat_ws(",", *reasons)
    return df.filter(reason == ""), df.withColumn("reject_reason", reason).filter("reject_reason != ''")


def _type_str(t: DataType) -> str:
    return t.simpleString()


def contract_gold(df: DataFrame, schema: StructType) -> DataFrame:
    """Return ``df`` unchanged if its column names and types equal ``schema`` exactly, else raise."""
    got = [(f.name, _type_str(f.dataType)) for f in df.schema.fields]
    want = [(f.name, _type_str(f.dataType)) for f in schema.fields]
    if got != want:
        missing = [w for w in want if w not in got]
        extra = [g for g in got if g not in want]
        raise ContractViolation(f"gold contract mismatch: missing={missing} unexpected={extra}")
    return df
