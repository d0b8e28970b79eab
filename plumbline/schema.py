"""Record layout and the column lists the checks work on."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The landed record, in order.
TARGET = StructType(
    [
        StructField("id", StringType()),
        StructField("comment", StringType()),
        StructField("votes_count", IntegerType()),
        StructField("os", StringType()),
        StructField("os_version", StringType()),
        StructField("country", StringType()),
        StructField("age", IntegerType()),
        StructField("customer_id", StringType()),
        StructField("cpf", StringType()),
        StructField("app_version", StringType()),
        StructField("rating", IntegerType()),
        StructField("timestamp", StringType()),
        StructField("app", StringType()),
    ]
)
COLUMNS = TARGET.fieldNames()

# Text columns that are folded and upper-cased.
TEXT_COLUMNS = ["comment", "os", "country"]

# Rows that agree on these columns are duplicates of each other.
DUPLICATE_KEY = ["customer_id", "app_version", "rating"]

# Columns whose NULLs the null check reports.
PROFILED_COLUMNS = ["customer_id", "rating", "comment", "app_version", "cpf", "os", "os_version", "timestamp"]

# A row is valid only if all of these are set: the profiled columns and ``app``.
REQUIRED_COLUMNS = PROFILED_COLUMNS + ["app"]

PARTITION_COLUMN = "odate"
LANDED = StructType(TARGET.fields + [StructField(PARTITION_COLUMN, StringType())])
