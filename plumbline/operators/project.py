"""Source document to processed record: flatten, project, normalise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import normalized
from plumbline.schema import COLUMNS, TEXT_COLUMNS


def flatten(documents: DataFrame, app: str) -> DataFrame:
    """Lift the nested id, keep the record columns in order and add ``app`` last.

    All other source columns are dropped here, so they are never read from a
    columnar source.
    """
    columns = [F.col(name) for name in COLUMNS if name not in ("id", "app")]
    return documents.select(F.col("_id.oid").alias("id"), *columns, F.lit(app).alias("app"))


def normalize(records: DataFrame) -> DataFrame:
    """Fold and upper-case the text columns.

    NULL stays NULL and no key column changes, so routing on NULLs and
    duplicates gives the same rows before and after this step. Route first:
    only rows that are written are folded then, and filters reach the scan.
    """
    return records.withColumns({name: normalized(F.col(name)) for name in TEXT_COLUMNS})


def process(documents: DataFrame, app: str) -> DataFrame:
    """The whole record transformation."""
    return normalize(flatten(documents, app))
