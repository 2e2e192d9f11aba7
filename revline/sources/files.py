"""CSV export/import and plain table folders.

Exports are written by every executor in parallel (one part file per task,
each with its header) instead of funnelling the data through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def export_csv(df: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> None:
    """Write ``df`` as CSV with a header, one part file per task.

    ``single_file`` is the caller's explicit choice to have one file, written
    by one task; ``compression`` (``gzip``) is another, for exports that are mostly
    repeated titles. Readers take the folder either way.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("compression", compression or "none").csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an exported CSV folder with a fixed schema (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
