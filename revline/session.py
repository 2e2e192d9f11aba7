"""Session helpers: one place for the settings every plan assumes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. Timestamps are converted with explicit
# arithmetic, but the session zone is still pinned so that any remaining
# zone-dependent expression (current_date, timestamp casts) is UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of DataFrames that are gone are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "revline") -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[N]``. A checkpoint folder is only set when the cluster names none.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` must name a folder that the driver
    and every executor see; it is never overridden, and without it this
    raises. Only a single-machine session (``local[N]``, tests) gets a
    private folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that the driver and "
            "all executors share")
    local = tempfile.mkdtemp(prefix="revline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for intermediate files."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/revline-scratch/{name}-{uuid.uuid4().hex[:12]}"


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with files that outlive any executor, keeps columnar
    pruning for the readers, and fixes the rows of a frame that is read twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside delete their shuffle files when they end. Without it the files of
    a job of many queries stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every scratch file of this session (frames that read them end)."""
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/revline-scratch"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
