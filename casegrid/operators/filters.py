"""Row filters, deterministic sampling and ordered limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions._util import to_col


def any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where at least one of ``cols`` is not null."""
    if not cols:
        raise ValueError("any_present needs at least one column")
    return df.where(F.coalesce(*[to_col(c) for c in cols]).isNotNull())


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, after a check that it has a row; an empty one is an error."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def all_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Conjunctive not-null filter (pushed into the Parquet scan)."""
    cond = None
    for c in cols:
        cond = to_col(c).isNotNull() if cond is None else cond & to_col(c).isNotNull()
    return df.where(cond)


def sample_key(seed: int, key) -> "F.Column":
    """Order key of the fixed-seed sample: md5 of '<seed>-<key>' (portable)."""
    return F.md5(F.concat(F.lit(f"{seed}-"), to_col(key).cast("string")))


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Fixed-size uniform sample without replacement: the ``min(n, rows)``
    rows with the smallest seeded hash of ``key`` (ties by key).

    Independent of partitioning and repeatable.  Planned as a top-n
    (TakeOrderedAndProject): each task keeps n rows, so only n * tasks rows
    move, whatever the input size.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    return df.orderBy(sample_key(seed, key), to_col(key)).limit(n)


def sample_many(df: DataFrame, n: int, seed: int, key: str, border_rows: int = 100_000) -> DataFrame:
    """The rows of ``sample_n``, in no order, for an ``n`` that one task cannot
    hold.

    Rows are counted by a prefix of their hash (four hex digits: 65,536 counts
    come to the driver).  All prefixes below the one where the count passes
    ``n`` are taken by a filter.  While the border prefix itself holds more than
    ``border_rows`` rows, it is counted by four more digits; only what is left of
    it is ordered.  The counting jobs read the key alone.  Rows that share a
    hash (a key that repeats) are the one group that is not divided further.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    hashed = F.coalesce(sample_key(seed, key), F.lit(""))  # a null key comes first, as in an ascending order
    below, border, left = F.lit(False), F.lit(True), n
    for digits in range(4, 36, 4):
        prefix = F.substring(hashed, 1, digits)
        counts = df.where(border).groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).orderBy("prefix")
        last = None
        for r in counts.collect():
            if r["n"] > left:
                last = r
                break
            left -= r["n"]
        if last is None:  # there are no more rows than asked for
            return df
        below, border = prefix < F.lit(last["prefix"]), prefix == F.lit(last["prefix"])
        if last["n"] <= border_rows or not left:
            break
    taken = df.where(below)
    return taken.unionByName(df.where(border).orderBy(sample_key(seed, key), to_col(key)).limit(left)) if left else taken


def limit_ordered(df: DataFrame, n: int, order_by: Sequence) -> DataFrame:
    """``LIMIT n`` made deterministic by an explicit order (top-n plan)."""
    return df.orderBy(*[to_col(c) for c in order_by]).limit(n)
