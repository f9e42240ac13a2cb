"""Tables that are replaced in whole or in part without a moment of absence.

A table is a folder of data folders and of manifests.  A manifest is a small
JSON file that names the data folders of one version; the one with the greatest
number is the table.  A writer first stores its data under a new name, then its
manifest under a temporary name, and renames that last.  So a write that fails
changes nothing, and a reader that resolved the table before goes on with files
that stay where they are: only folders that neither the new version nor the one
before it names are removed.

Keyed state (``merge_into``) is stored by a hash of its keys.  A run rewrites
the parts whose keys it touches; the new manifest names the other parts' folders
as they are.

Files are listed, renamed and removed through the Hadoop file system of the
table's path, so any store that Spark writes to will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS, BUCKET = "_manifests", "key_bucket"
BUCKETS = 64


class Conflict(RuntimeError):
    """Another run changed the table in the meantime."""


@dataclass
class Version:
    """One version of a table: its number, its data folders (relative to the
    table), and for keyed state the folder of each part."""
    number: int = 0
    folders: list[str] = field(default_factory=list)
    parts: dict[int, str] = field(default_factory=dict)
    buckets: int = 0

    def named(self) -> set[str]:
        return {f.split("/")[0] for f in [*self.folders, *self.parts.values()]}


class Store:
    """The few file operations needed, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, jvm = spark, path.rstrip("/"), spark._jvm
        self._path, self._io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self._path("/".join([self.path, *names]))

    def names(self, *folder: str) -> list[str]:
        at = self.at(*folder)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, *names: str) -> str:
        stream = self.fs.open(self.at(*names))
        try:
            return bytes(self._io.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, text: str, *names: str) -> None:
        stream = self.fs.create(self.at(*names), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def remove(self, *names: str) -> None:
        self.fs.delete(self.at(*names), True)


def _manifest(store: Store, name: str) -> Version:
    found = json.loads(store.read(MANIFESTS, name))
    return Version(int(name), found["folders"], {int(k): v for k, v in found["parts"].items()}, found["buckets"])


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that is the table now; None where there is none."""
    store = Store(spark, path)
    numbers = [n for n in store.names(MANIFESTS) if n.isdigit()]
    return _manifest(store, numbers[-1]) if numbers else None


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Makes ``version`` the table, and removes what neither it nor the one
    before it names.  A number that is taken is a conflict."""
    store, name = Store(spark, path), f"{version.number:012d}"
    text = json.dumps({"folders": version.folders, "buckets": version.buckets,
                       "parts": {str(k): v for k, v in sorted(version.parts.items())}})
    temporary = f"new-{uuid.uuid4().hex}"
    store.write(text, MANIFESTS, temporary)
    if name in store.names(MANIFESTS) or not store.fs.rename(store.at(MANIFESTS, temporary), store.at(MANIFESTS, name)):
        store.remove(MANIFESTS, temporary)
        raise Conflict(f"version {version.number} of {path} was written by another run")
    numbers = [n for n in store.names(MANIFESTS) if n.isdigit()]
    old = {n: _manifest(store, n).named() for n in numbers[:-2]}
    still = version.named().union(*[_manifest(store, n).named() for n in numbers[-2:]])
    for n, folders in old.items():
        for folder in folders - still:
            store.remove(folder)
        store.remove(MANIFESTS, n)


def _fresh() -> str:
    return f"data-{uuid.uuid4().hex}"


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Make ``df`` the table at ``path`` and return its row count, counted by
    an Observation during the write.  ``path`` may be an input of ``df``."""
    spark, folder, obs = df.sparkSession, _fresh(), Observation("replace")
    before = current(spark, path)
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path.rstrip('/')}/{folder}")
    publish(spark, path, Version((before.number if before else 0) + 1, [folder]))
    return int(obs.get["rows"])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as it is now.  With a ``schema`` a table that was never
    written is empty, without one it is an error."""
    now = current(spark, path)
    if now is None and schema is None:
        raise AnalysisException(f"no table at {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    folders = [] if now is None else [f"{path.rstrip('/')}/{f}" for f in [*now.folders, *sorted(now.parts.values())]]
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


def bucket_of(keys: Sequence[str], buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _without(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys, null or not, ``others`` does not have."""
    known = others.select(F.col(BUCKET).alias("_b"), *[F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)])
    same = F.col(BUCKET) == F.col("_b")
    for i, k in enumerate(keys):
        same &= F.col(f"`{k}`").eqNullSafe(F.col(f"_{i}"))
    return rows.join(known, same, "left_anti")


def merge_into(rows: DataFrame, path: str, keys: Sequence[str], replace: bool = True, buckets: int = BUCKETS) -> list[int]:
    """Merge ``rows`` (unique on ``keys``) into the state at ``path`` and
    return the numbers of the parts that were rewritten.

    ``replace``: rows take the place of stored ones with their key; otherwise
    stored rows win.  The number of parts is that of the first run.  The driver
    learns which parts are touched, at most ``buckets`` numbers.  Stored rows of
    other parts are neither read nor written.  ``rows`` should be stored: they
    are read twice.
    """
    spark, keys = rows.sparkSession, list(keys)
    now = current(spark, path) or Version(buckets=buckets)
    tagged = rows.withColumn(BUCKET, bucket_of(keys, now.buckets))
    touched = sorted(r[0] for r in tagged.select(BUCKET).distinct().collect())
    if not touched:
        return []
    base, folder = path.rstrip("/"), _fresh()
    held = [f"{base}/{now.parts[b]}" for b in touched if b in now.parts]
    merged = tagged
    if held:
        stored = spark.read.schema(rows.schema).parquet(*held).withColumn(BUCKET, bucket_of(keys, now.buckets))
        kept, added = (_without(stored, tagged, keys), tagged) if replace else (stored, _without(tagged, stored, keys))
        merged = kept.unionByName(added)
    merged.repartition(BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{base}/{folder}")
    parts = now.parts | {int(n.split("=")[1]): f"{folder}/{n}" for n in Store(spark, path).names(folder) if "=" in n}
    publish(spark, path, Version(now.number + 1, [], parts, now.buckets))
    return touched
