"""A review collection derived from the tables ``events`` and ``documents``.

One review per event; its comment is the whole text of a document, and every
document is used in turn. NULLs, texts and fractions among the ratings and
repeated keys are put in at fixed rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _null_every(rate: int, value: Column) -> Column:
    return F.when(F.col("event_id") % rate != 0, value)


def review_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source documents: a nested id, text columns only, one column the records do not keep."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    event, user = F.col("event_id"), F.col("user_id").cast("string")
    # Both tables grow with the scale; merged on the key, the reviews come out evenly spread.
    events = events.withColumn("doc_id", event % documents.select(F.count(F.lit(1))).scalar())
    joined = events.join(documents.hint("merge"), "doc_id")
    country = (
        F.when(F.col("lang") == "es", "España")
        .when(F.col("lang") == "de", "Österreich")
        .when(F.col("lang") == "fr", "Québec")
        .otherwise("US")
    )
    rating = (
        F.when(event % 97 == 0, F.lit(None).cast("string"))
        .when(event % 89 == 0, "abc")
        .when(event % 83 == 0, "3.7")
        .otherwise((event % 5 + 1).cast("string"))
    )
    return joined.select(
        F.struct(event.cast("string").alias("oid")).alias("_id"),
        _null_every(109, user).alias("customer_id"),
        rating.alias("rating"),
        _null_every(103, F.col("text")).alias("comment"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.concat(F.lit("1."), (event % 40).cast("string"), F.lit(".0")).alias("app_version"),
        country.alias("country"),
        _null_every(101, F.lpad(user, 11, "0")).alias("cpf"),
        (F.col("user_id") % 60 + 18).cast("string").alias("age"),
        (event % 11).cast("string").alias("votes_count"),
        F.concat(F.lit("10.0.0."), (event % 256).cast("string")).alias("ip_address"),
        _null_every(107, F.when(event % 2 == 0, "Android").otherwise("iOS")).alias("os"),
        (event % 9 + 10).cast("string").alias("os_version"),
    )
