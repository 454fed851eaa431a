"""Declarative data-quality checks and their report.

All row checks of a table share one scan and one aggregate.  Uniqueness and relationships count per
key before anything is joined, so a key with many rows travels as one row per map task.  ``Watch`` measures row checks
while a table is written, ``load_checks`` judges a load by its own keys.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

ERROR, WARN = "error", "warn"
REPORT_SCHEMA = "table_name string, column_name string, check_name string, severity string, n_violations bigint"
KEY_KINDS = ("unique", "unique_combination", "relationship")


@dataclass(frozen=True)
class Check:
    """One assertion on one table; ``columns`` names what it looks at."""

    table: str
    columns: tuple[str, ...]
    kind: str
    severity: str = ERROR
    options: Mapping[str, object] = field(default_factory=dict)

    def warn(self) -> Check:
        return replace(self, severity=WARN)

    @property
    def column(self) -> str:
        return ",".join(self.columns)


class ContractViolation(Exception):
    """An error-level check found violations."""


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, (c,), "not_null") for c in columns]


def unique(table: str, column: str) -> Check:
    return Check(table, (column,), "unique")


def unique_combination(table: str, *columns: str) -> Check:
    return Check(table, columns, "unique_combination")


def relationship(table: str, column: str, to_table: str, to_column: str) -> Check:
    return Check(table, (column,), "relationship", options={"to": to_table, "field": to_column})


def accepted_values(table: str, column: str, values: Sequence[object]) -> Check:
    return Check(table, (column,), "accepted_values", options={"values": list(values)})


def between(
    table: str, column: str, low: object = None, high: object = None, row_condition: str | None = None
) -> Check:
    return Check(table, (column,), "between", options={"low": low, "high": high, "where": row_condition})


def matches(table: str, column: str, pattern: str) -> Check:
    return Check(table, (column,), "matches", options={"pattern": pattern})


def has_type(table: str, column: str, type_name: str) -> Check:
    return Check(table, (column,), "has_type", options={"type": type_name})


def _violation(check: Check) -> Column:
    """True on a row that breaks a row check; nulls only break ``not_null``."""
    c = F.col(check.columns[0])
    opt = check.options
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "has_type":
        # Every value under another type is a violation.
        return c.isNotNull() & (F.typeof(c) != str(opt["type"]).lower())
    if check.kind == "accepted_values":
        return ~c.isin(opt["values"])
    if check.kind == "matches":
        return ~c.rlike(str(opt["pattern"]))
    if check.kind == "between":
        outside = [c < F.lit(opt["low"])] if opt["low"] is not None else []
        outside += [c > F.lit(opt["high"])] if opt["high"] is not None else []
        bad = reduce(lambda a, b: a | b, outside, F.lit(False))
        return bad if opt["where"] is None else F.expr(str(opt["where"])) & bad
    raise ValueError(f"not a row check: {check.kind}")


def _row(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        violations.cast("bigint").alias("n_violations"),
    )


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts, rows = [], []
    for i, check in enumerate(checks):
        counts.append(F.count_if(_violation(check)).alias(f"_c{i}"))
        rows.append(_row(check, F.col(f"_c{i}")))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _uniqueness(df: DataFrame, check: Check) -> DataFrame:
    """Number of key groups that occur more than once."""
    rows = df
    if check.kind == "unique":
        rows = df.filter(F.col(check.columns[0]).isNotNull())
    groups = rows.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n"))
    repeated = groups.agg(F.count_if(F.col("_n") > 1).alias("_v"))
    return repeated.select(F.inline(F.array(_row(check, F.col("_v")))))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Non-null child keys without a parent, with the number of rows that carry each."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(parent.select(F.col(field_name).alias(column)), column, "left_anti")


def _relationship(df: DataFrame, check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    parent = tables[str(check.options["to"])]
    orphans = orphan_keys(df, check.columns[0], parent, str(check.options["field"]))
    total = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("_v"))
    return total.select(F.inline(F.array(_row(check, F.col("_v")))))


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Report with one row per check: table, column, check, severity, number of violations."""
    row_checks: dict[str, list[Check]] = defaultdict(list)
    parts: list[DataFrame] = []
    for check in checks:
        df = tables[check.table]
        if check.kind in ("unique", "unique_combination"):
            parts.append(_uniqueness(df, check))
        elif check.kind == "relationship":
            parts.append(_relationship(df, check, tables))
        else:
            row_checks[check.table].append(check)
    parts += [_row_checks(tables[name], group) for name, group in row_checks.items()]
    if not parts:
        raise ValueError("no checks were given")
    return reduce(DataFrame.unionByName, parts)


def load_checks(
    stored: DataFrame, batch: DataFrame, tables: Mapping[str, DataFrame], checks: Iterable[Check], used: list[str] | None = None
) -> DataFrame:
    """Uniqueness and relationships of ``stored`` as they will be with ``batch`` in it, judged by the batch's keys.

    ``stored`` must have passed before.  A key group breaks uniqueness if it comes several times in the batch or is stored
    already.  The batch's keys are counted and written first: those that fit a broadcast meet the stored keys where they
    lie, more of them are shuffled to the buckets of a bucketed table, so stored keys do not move.
    """
    parts = []
    for check in checks:
        keys = list(check.columns)
        if check.kind == "relationship":
            parts.append(_relationship(batch, check, tables))
        elif check.kind in ("unique", "unique_combination"):
            rows = batch.filter(F.col(keys[0]).isNotNull()) if check.kind == "unique" else batch
            groups = materialise(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "load-keys", used)
            met = stored_hits(stored, groups, keys).distinct()
            broken = groups.filter(F.col("_n") > 1).select(*keys).unionByName(met).distinct()
            parts.append(broken.agg(F.count(F.lit(1)).alias("_v")).select(F.inline(F.array(_row(check, F.col("_v"))))))
        else:
            raise ValueError(f"not a check of keys: {check.kind}")
    if not parts:
        raise ValueError("no checks were given")
    return reduce(DataFrame.unionByName, parts)


def stored_hits(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys that the batch has too; null keys are no keys."""
    return stored.select(*keys).join(batch.select(*keys), list(keys), "left_semi")


class Watch:
    """Row checks and further figures of a frame, measured while it is written.

    It belongs right below the write, in the last stage of the job: what a lost attempt of a task has counted is dropped
    with it there, while the stages before it may run, and count, twice.
    """

    def __init__(self, checks: Iterable[Check] = (), **figures: Column):
        self.checks = list(checks)
        self._figures = figures
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """``df`` with the measurement attached; to be written once."""
        counts = [F.count_if(_violation(c)).alias(f"_c{i}") for i, c in enumerate(self.checks)]
        return df.observe(self._seen, *counts, *[c.alias(name) for name, c in self._figures.items()])

    def __getitem__(self, name: str):
        """A figure, once the frame is written."""
        return self._seen.get[name]

    def report(self, spark: SparkSession) -> DataFrame:
        """Report like that of ``run_checks``, one row per check."""
        rows = [(c.table, c.column, c.kind, c.severity, self[f"_c{i}"]) for i, c in enumerate(self.checks)]
        return spark.createDataFrame(rows, REPORT_SCHEMA)


def raise_on_error(report: DataFrame) -> list:
    """Raise when an error-level check has violations; return the warnings that fired.

    The report has one row per check, so it is small by construction.
    """
    fired = report.filter(F.col("n_violations") > 0).collect()
    errors = [r for r in fired if r["severity"] == ERROR]
    if errors:
        text = "; ".join(f"{r['table_name']}.{r['column_name']} {r['check_name']}: {r['n_violations']}" for r in errors)
        raise ContractViolation(text)
    return fired
