"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions._util import to_col


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                   tie_breakers: Sequence = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by`` then ``tie_breakers``,
    all descending with nulls last.

    Written as a ``max_by`` aggregate, not a sorted window: the aggregate is
    combined map-side, so a key holding a large share of the rows is reduced
    to one row per input task before the shuffle and never lands in one task.
    Null members of a struct order first, which gives "desc nulls last".
    Pass a unique tie-breaker: without it the pick among ties is arbitrary.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[to_col(c).alias(f"_o{i}") for i, c in
                          enumerate([*order_by, *tie_breakers])])
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), ordering).alias("_latest"))
    return picked.select(*[F.col(f"`{k}`") for k in keys],
                         *[F.col("_latest").getField(c).alias(c) for c in rest])
