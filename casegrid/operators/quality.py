"""Data-quality checks.

A check is a violation query (empty = pass).  Checks on the rows of one table
(not null, accepted values, ranges, row count, coverage) are ``ScanCheck``s:
``report`` folds all of a table into one aggregate, so a table is scanned once
however many such checks it has.  ``KeyCheck``s (uniqueness) of all tables share
one shuffle of tagged keys.  Only relationships have plans of their own.
``gate`` reads the bounded report (one row
per check) and raises on a failed error-severity check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.functions._util import to_col
from casegrid.operators.evaluation import coverage_below
from casegrid.operators.joins import balanced_join

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class Check:
    """A violation query of its own."""
    name: str
    build: Callable[[], DataFrame] = field(repr=False)
    severity: str = ERROR

    def violations(self) -> DataFrame:
        return self.build()


@dataclass(frozen=True)
class ScanCheck:
    """An aggregate of one table that gives the number of violations."""
    name: str
    frame: DataFrame = field(repr=False)
    violations: Column = field(repr=False)
    severity: str = ERROR


@dataclass(frozen=True)
class KeyCheck:
    """A column of a table whose values, nulls aside, must not repeat."""
    name: str
    frame: DataFrame = field(repr=False)
    column: str
    severity: str = ERROR


# ------------------------------------------------------ violation rows ----

def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(to_col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Keys that occur more than once, with their counts (nulls ignored).
    Partial aggregation pre-combines a hot key before the shuffle."""
    return (df.where(to_col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def _outside(col: str, values: Sequence) -> Column:
    return ~to_col(col).isin(list(values))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside ``values``; null passes."""
    return df.where(_outside(col, values))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join; a key that
    holds a large share of the child rows is split over many tasks)."""
    p = parent.select(F.col(parent_col).alias(col)).distinct()
    rows = child.where(to_col(col).isNotNull())
    return balanced_join(rows, p, col, F.struct(*rows.columns), "left_anti")


def _out_of_range(col: str, min_value, max_value, row_condition: str | None) -> Column:
    c = to_col(col)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & (c >= F.lit(min_value))
    if max_value is not None:
        ok = ok & (c <= F.lit(max_value))
    bad = ~ok
    if row_condition:
        bad = F.expr(row_condition) & bad
    # a null comparison is not a violation
    return F.coalesce(bad, F.lit(False))


def between(df: DataFrame, col: str, min_value=None, max_value=None,
            row_condition: str | None = None) -> DataFrame:
    return df.where(_out_of_range(col, min_value, max_value, row_condition))


def row_count(df: DataFrame, min_value: int | None = None, max_value: int | None = None) -> DataFrame:
    """One row (the count) when the row count is outside the bounds."""
    n = F.col("row_count")
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (n < min_value)
    if max_value is not None:
        bad = bad | (n > max_value)
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(bad)


def coverage(df: DataFrame, col: str, threshold: float = 0.90) -> DataFrame:
    return coverage_below(df, col, threshold)


def freshness(df: DataFrame, loaded_at, as_of: datetime, warn_after_days: int = 90) -> DataFrame:
    """One row when the newest load time is older than ``warn_after_days``
    before ``as_of`` (a parameter, so the check is reproducible)."""
    agg = df.agg(F.max(to_col(loaded_at)).alias("max_loaded_at"))
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("max_loaded_at"))
    return agg.select("max_loaded_at", age.alias("age_days")).where(
        F.col("age_days") > warn_after_days)


# ------------------------------------------------ the rows that fail ----

MASK = "dq_mask"


@dataclass(frozen=True)
class RowCheck:
    """A condition that a row must not meet."""
    name: str
    violated: Column = field(repr=False)


def row_not_null(name: str, col: str) -> RowCheck:
    return RowCheck(name, to_col(col).isNull())


def row_accepted(name: str, col: str, values: Sequence) -> RowCheck:
    return RowCheck(name, _outside(col, values))


def row_between(name: str, col: str, min_value=None, max_value=None, row_condition: str | None = None) -> RowCheck:
    return RowCheck(name, _out_of_range(col, min_value, max_value, row_condition))


def violating_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """The rows that fail any check, with ``dq_mask``: bit k is set where check
    k fails (63 checks at most).  One scan, no shuffle."""
    if not 0 < len(checks) < 64:
        raise ValueError("1 to 63 checks fit in a mask")
    bits = [F.when(c.violated, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate(checks)]
    return df.withColumn(MASK, reduce(Column.bitwiseOR, bits)).where(F.col(MASK) != 0)


def mask_counts(rows: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """``(check_name, violations)`` from the masks of ``violating_rows``."""
    set_ = lambda k: F.getbit(F.col(MASK), F.lit(k)) == 1
    one = rows.agg(*[F.count_if(set_(k)).alias(f"n{k}") for k in range(len(checks))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"n{k}").alias("violations"))
                                         for k, c in enumerate(checks)])))


# ------------------------------------------- the same, folded into a scan ----

def scan_not_null(name: str, df: DataFrame, col: str, severity: str = ERROR) -> ScanCheck:
    return ScanCheck(name, df, F.count_if(to_col(col).isNull()), severity)


def scan_accepted(name: str, df: DataFrame, col: str, values: Sequence, severity: str = ERROR) -> ScanCheck:
    return ScanCheck(name, df, F.count_if(_outside(col, values)), severity)


def scan_between(name: str, df: DataFrame, col: str, min_value=None, max_value=None,
                 row_condition: str | None = None, severity: str = ERROR) -> ScanCheck:
    return ScanCheck(name, df, F.count_if(_out_of_range(col, min_value, max_value, row_condition)), severity)


def scan_row_count(name: str, df: DataFrame, min_value: int = 1, severity: str = ERROR) -> ScanCheck:
    return ScanCheck(name, df, (F.count(F.lit(1)) < min_value).cast("bigint"), severity)


def scan_coverage(name: str, df: DataFrame, col: str, threshold: float = 0.90, severity: str = ERROR) -> ScanCheck:
    share = F.try_divide(F.count(to_col(col)).cast("double"), F.count(F.lit(1)))  # null for no rows
    return ScanCheck(name, df, F.coalesce(share < threshold, F.lit(False)).cast("bigint"), severity)


def scan_freshness(name: str, df: DataFrame, loaded_at: Column, as_of: datetime, warn_after_days: int = 90,
                   severity: str = WARN) -> ScanCheck:
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date(F.max(loaded_at)))
    return ScanCheck(name, df, F.coalesce(age > warn_after_days, F.lit(False)).cast("bigint"), severity)


def _listed(one_row: DataFrame, checks: Sequence[ScanCheck | KeyCheck]) -> DataFrame:
    """``n0, n1, ...`` of one row as a row per check."""
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"n{k}").alias("n"))
        for k, c in enumerate(checks)])))


def repeated_keys(checks: Sequence[KeyCheck]) -> DataFrame:
    """``(check, key, n_records)`` of the keys that occur more than once:
    ``check`` is the number of the check, ``key`` the value as text.  All
    checks are one aggregate over tagged keys, combined map-side first."""
    tagged = [c.frame.where(to_col(c.column).isNotNull()).select(
        F.lit(k).alias("check"), to_col(c.column).cast("string").alias("key")) for k, c in enumerate(checks)]
    return (reduce(DataFrame.unionByName, tagged).groupBy("check", "key")
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def report(checks: Iterable[Check | ScanCheck | KeyCheck]) -> DataFrame:
    """(check_name, severity, violations bigint, passed boolean), one row per check."""
    checks = list(checks)
    if not checks:
        raise ValueError("no checks")
    parts, by_frame = [], {}
    keys = [c for c in checks if isinstance(c, KeyCheck)]
    for c in checks:
        if isinstance(c, ScanCheck):
            by_frame.setdefault(id(c.frame), []).append(c)
        elif isinstance(c, Check):
            parts.append(c.violations().agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "n"))
    for group in by_frame.values():
        parts.append(_listed(group[0].frame.agg(*[
            c.violations.cast("bigint").alias(f"n{k}") for k, c in enumerate(group)]), group))
    if keys:
        parts.append(_listed(repeated_keys(keys).agg(*[
            F.count_if(F.col("check") == k).alias(f"n{k}") for k in range(len(keys))]), keys))
    out = reduce(DataFrame.unionByName, parts)
    return out.select("check_name", "severity", F.col("n").cast("bigint").alias("violations"),
                      (F.col("n") == 0).alias("passed"))


class QualityGateError(RuntimeError):
    pass


def gate(report_df: DataFrame) -> list:
    """Raise when an error-severity check failed; return the report rows.
    The report has one row per check, so collecting it is bounded."""
    rows = report_df.collect()
    failed = [r.check_name for r in rows if r.severity == ERROR and not r.passed]
    if failed:
        raise QualityGateError(f"data-quality checks failed: {failed}")
    return rows
