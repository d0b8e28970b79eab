"""The landed table as a source: what has been loaded so far."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.schema import LANDED, PARTITION_COLUMN
from plumbline.storage import child_names, path_exists

_DAY_FOLDER = re.compile(rf"{PARTITION_COLUMN}=(\d{{8}})")


def read_landed(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """The landed table, or one day of it.

    The schema is given: left to inference, the partition value would come back
    as an integer and no longer compare or parse as a date text.
    """
    reader = spark.read.schema(LANDED)
    if day is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(f"{path.rstrip('/')}/{PARTITION_COLUMN}={day}")


def day_mark(landed: DataFrame, load_date: str) -> DataFrame:
    """The high-water mark as one row: the last load day before ``load_date``, as ISO text.

    Only days strictly before the load date count. A second run on the same day
    then reads what the first one read and replaces its partition completely.
    """
    last = landed.filter(F.col(PARTITION_COLUMN) < load_date).agg(F.max(PARTITION_COLUMN).alias("day"))
    return last.select(F.date_format(F.to_date("day", "yyyyMMdd"), "yyyy-MM-dd'T'HH:mm:ss").alias("mark"))


def high_water_mark(spark: SparkSession, path: str, load_date: str) -> str | None:
    """:func:`day_mark` without opening the files of every day.

    The day folders are listed once; the newest one that holds a row decides, so
    the cost does not grow with the table.
    """
    if not path_exists(spark, path):
        return None
    days = [match[1] for match in map(_DAY_FOLDER.fullmatch, child_names(spark, path)) if match]
    for day in sorted((day for day in days if day < load_date), reverse=True):
        landed = read_landed(spark, path, day)
        if not landed.isEmpty():
            return day_mark(landed.select(PARTITION_COLUMN).limit(1), load_date).first()["mark"]
    return None
