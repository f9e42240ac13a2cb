"""Parquet table helpers: idempotent reload, absent-as-empty reads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casegrid.sources.versions import replace_table


def reload_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Replace the table at ``path`` with ``df`` and return the row count.
    Re-running with the same input leaves the same table (idempotent).  The old
    rows stay readable until the new ones are complete (see ``versions``);
    ``versions.read_table`` reads it."""
    return replace_table(df, path, partition_by or ())


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A missing table reads as an empty table with the declared schema."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "does not exist" in str(err).lower():
            return spark.createDataFrame([], schema)
        raise
