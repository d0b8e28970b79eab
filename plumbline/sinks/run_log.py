"""One JSON document per run, appended to a table of successes or of failures."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SUCCESS = "success"
FAIL = "fail"

_LOG = StructType([StructField("document", StringType()), StructField("metrics_type", StringType())])


@dataclass(frozen=True)
class JobLabels:
    """Who a failure document belongs to."""

    layer: str = "bronze"
    project: str = "reviews"
    job: str = "review_landing"
    priority: str = "0"
    torre: str = "REVIEWS"


def _append(document: DataFrame, metrics_type: str, path: str) -> None:
    rows = document.select("document", F.lit(metrics_type).alias("metrics_type"))
    rows.write.mode("append").partitionBy("metrics_type").text(path)


def append_success(spark: SparkSession, path: str, document: DataFrame | dict | str) -> None:
    """Append a run document as it is: a frame with a ``document`` column, a dict or JSON text."""
    if isinstance(document, DataFrame):
        _append(document, SUCCESS, path)
        return
    if not document:
        raise ValueError("a success needs a document")
    if isinstance(document, str):
        try:
            document = json.loads(document)
        except json.JSONDecodeError as error:
            raise ValueError("the document is not valid JSON") from error
    line = json.dumps(document, ensure_ascii=False)
    _append(spark.range(1).select(F.lit(line).alias("document")), SUCCESS, path)


def failure_document(
    spark: SparkSession, error: Exception | str, client: str | None = None, labels: JobLabels = JobLabels()
) -> DataFrame:
    """The failure document, a row with fixed fields. Its time is taken when the row is computed, in UTC."""
    if not error:
        raise ValueError("a failure needs an error")
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    # The names of the fields and the client of a run without one.
    fields = [
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.lit(labels.layer).alias("layer"),
        F.lit(labels.project).alias("project"),
        F.lit(labels.job).alias("job"),
        F.lit(labels.priority).alias("priority"),
        F.lit(labels.torre).alias("torre"),
        F.lit(client.upper() if client else "UNKNOWN_CLIENT").alias("client"),
        F.lit(str(error)).alias("error"),
    ]
    return spark.range(1).select(F.to_json(F.struct(*fields)).alias("document"))


def append_failure(
    spark: SparkSession,
    path: str,
    error: Exception | str,
    client: str | None = None,
    labels: JobLabels = JobLabels(),
) -> None:
    _append(failure_document(spark, error, client, labels), FAIL, path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """All documents with their type."""
    return spark.read.schema(_LOG).text(path)
