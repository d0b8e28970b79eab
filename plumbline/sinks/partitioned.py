"""Date-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators.conform import conform
from plumbline.schema import PARTITION_COLUMN
from plumbline.storage import REPEATED_TEXT


def land(
    df: DataFrame,
    path: str,
    load_date: str,
    schema: StructType | None = None,
    partition_column: str = PARTITION_COLUMN,
    compression: str = "snappy",
    counters: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Write one load date and return ``{"rows": ..., **counters}`` of what was written.

    The counts are observed during the write, so neither an emptiness probe nor
    a count runs the plan a second time. Other load dates stay; the given one is
    replaced. An empty frame replaces nothing.
    """
    if schema is not None:
        df = conform(df, schema)
    written = Observation()
    counters = {"rows": F.count(F.lit(1)), **(counters or {})}
    observed = df.observe(written, *[column.alias(name) for name, column in counters.items()])
    (
        observed.withColumn(partition_column, F.lit(load_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(compression=compression, **REPEATED_TEXT)
        .partitionBy(partition_column)
        .parquet(path)
    )
    return {name: written.get.get(name, 0) for name in counters}
