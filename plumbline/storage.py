"""Paths, through the file system the session is configured for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A text that many rows hold is written once per row group, not once per row. The default of 1 MB holds a few hundred
# long texts; a column without repeats leaves its dictionary after the first page, whatever the limit. Row groups end
# before the dictionary is full, which would leave the rest of their rows without one, however large the table.
REPEATED_TEXT = {"parquet.dictionary.page.size": str(64 << 20), "parquet.block.row.count.limit": "50000"}


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _file_system(spark, path)
    return file_system.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``: one directory listing, no recursion."""
    file_system, target = _file_system(spark, path)
    return [status.getPath().getName() for status in file_system.listStatus(target)]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of :func:`shared_folder` with all it holds."""
    file_system, target = _file_system(spark, path)
    file_system.delete(target, True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder for tables that cut lineage, under ``spark.checkpoint.dir``.

    Who asks for it deletes it (:func:`delete_folder`). Only a local session
    may do without the setting; it gets a fresh temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="plumbline-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str) -> None:
    """Write a table of :func:`shared_folder`: repeated texts once, the rest packed well."""
    df.write.mode("overwrite").options(compression="zstd", **REPEATED_TEXT).parquet(path)
