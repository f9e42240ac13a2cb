"""Many-to-one joins that stay balanced when one key holds a large share of
the rows (a popular establishment, a missing id, a boilerplate narrative).

A key is hot when it holds more rows than an even partition would, that is
more than ``1 / partitions`` of them; so there are fewer than ``partitions``
hot keys, whatever the input size, and that bound is what lets one small job
bring them to the driver.  A hot key's rows are spread over as many salt
values as the partitions' worth of rows it holds, by a deterministic hash of a
row id (a retried task computes the same salt), and its one-side row is
replicated once per salt: at most ``2 * partitions`` extra rows in all.  Cold
keys join unchanged, and with no hot key the join is a plain join.

The null key is counted like any other.  It matches nothing, but in an outer
or anti join its rows still have to be dealt out, so they are spread too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.session import shuffles_freed


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, key: str, n_col: str = "n", partitions: int | None = None) -> dict:
    """Hot values of ``key`` with the number of salts each needs (a power of
    two, so that few distinct numbers occur).

    One small job: the total is a scalar subquery of the same plan, and fewer
    than ``partitions`` values can qualify.
    """
    partitions = partitions or shuffle_partitions(counts)
    if partitions < 2:
        return {}
    total = counts.agg(F.sum(n_col)).scalar()
    share = F.col(n_col) / total
    with shuffles_freed(counts.sparkSession):
        rows = (counts.where(F.col(n_col) * partitions > total)
                .select(F.col(key).alias("k"), share.cast("double").alias("share")).collect())
    if len(rows) >= partitions:
        raise RuntimeError("more hot keys than the bound allows")
    out = {}
    for r in rows:
        salts = 2
        while salts < r["share"] * partitions:
            salts *= 2
        out[r["k"]] = salts
    return out


def _salts(key: Column, hot: dict) -> Column:
    """Number of salts of a key: 1 unless it is hot."""
    by_number: dict[int, list] = {}
    for k, n in hot.items():
        by_number.setdefault(n, []).append(k)
    out = F.lit(1)
    for n, keys in by_number.items():
        known = [k for k in keys if k is not None]
        match = key.isin(known) if known else F.lit(False)
        if None in keys:
            match = key.isNull() | F.coalesce(match, F.lit(False))
        out = F.when(match, F.lit(n)).otherwise(out)
    return out


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: dict, salt_of: Column,
                how: str = "left") -> DataFrame:
    """``big`` join ``small`` (unique on ``key``) with the ``hot`` key values
    salted; ``salt_of`` is a column of ``big`` that identifies a row."""
    if not hot:
        return big.join(small, key, how)
    salts = _salts(F.col(key), hot)
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(salt_of), salts).cast("int"))
    spread_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted_big.join(spread_small, [key, "_salt"], how).drop("_salt")


def balanced_join(big: DataFrame, small: DataFrame, key: str, salt_of: Column, how: str = "left") -> DataFrame:
    """``salted_join`` that first counts the keys of ``big`` (its key column
    alone, combined map-side)."""
    return salted_join(big, small, key, hot_keys(key_counts(big.select(key), [key]), key), salt_of, how)
