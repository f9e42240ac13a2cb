"""Session helpers: a tuned local session for tests/bench, and the shared
scratch location used for lineage cuts and intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

# Settings that matter at scale; the local builder uses them and cluster
# sessions are expected to carry equivalent values.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "casegrid") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is read from the session.  A
    private one is created only when the setting is absent and the master is
    local; on a cluster each executor would write to its own disk, so a missing
    setting raises there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               f"executors share (master {sc.master})")
        conf_dir = tempfile.mkdtemp(prefix="casegrid-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:  # noqa: BLE001 - a core conf may be read-only at runtime
            pass
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base.rstrip("/"), f"casegrid-{name}-{uuid.uuid4().hex}")
    for scope in _open_scopes:
        scope.append(path)
    return path


@contextmanager
def scratch_scope():
    """Remove the scratch tables made inside the block when it ends.  Only for
    work whose results are stored by then: a lazy result still reads them."""
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for path in made:
            store, name = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
            if store.get_file_info(name).type == fs.FileType.Directory:
                store.delete_dir(name)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """The shuffle files of what runs inside the block go when each execution
    ends, not when the driver happens to collect its garbage.  For writes and
    counts: nothing reads the shuffles of their plan again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialise(df, name: str = "table", codec: str | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a DataFrame over the written files: cuts the lineage like a
    checkpoint, survives executor loss, and (unlike a checkpoint) lets later
    readers prune columns and push filters into the scan.  The shuffles that
    led to the table are freed once it is written.  ``codec`` names the
    compression; "zstd" halves columns of hexadecimal hashes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    with shuffles_freed(spark):
        (writer.option("compression", codec) if codec else writer).parquet(path)
    return spark.read.parquet(path)
