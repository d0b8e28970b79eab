"""Fit a frame to a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructField, StructType

from plumbline.functions import safe_int
from plumbline.schema import TARGET


def _fit(field: StructField, found: DataType) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, IntegerType) and not isinstance(found, IntegerType):
        column = safe_int(column) if isinstance(found, StringType) else column.try_cast("int")
    elif isinstance(field.dataType, StringType) and not isinstance(found, StringType):
        column = column.cast("string")
    return column.alias(field.name)


def conform(df: DataFrame, schema: StructType = TARGET) -> DataFrame:
    """One projection: integers and strings are cast, other types kept, schema order, nothing else.

    A column the schema names and the frame lacks is an analysis error.
    """
    found = df.select(*schema.fieldNames()).schema
    return df.select(*[_fit(field, given.dataType) for field, given in zip(schema, found, strict=True)])
