"""Set-based keyed writes: upsert (replace by key) and insert-if-absent.

As expressions they give the whole table.  Stored state is merged into by
``sources.versions.merge_into``, which rewrites only the parts that hold the keys
of a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``updates`` replace target rows with the same key; other
    target rows stay.  ``updates`` must be unique on ``keys``."""
    keys = list(keys)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def insert_if_absent(target: DataFrame, new_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``ON CONFLICT DO NOTHING``: existing rows win, new keys are appended.
    ``new_rows`` must be unique on ``keys``."""
    keys = list(keys)
    fresh = new_rows.select(*target.columns).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)
