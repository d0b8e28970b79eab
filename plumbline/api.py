"""The job's functions under the names scripts call them by.

Thin: each one composes operators and, where it returns plain Python values,
runs the one action that needs.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions import ascii_fold as remove_accents
from plumbline.metrics import RunInfo, application_log, parse_stage_report, stage_metrics, stage_totals
from plumbline.metrics.document import document_column
from plumbline.operators import conform, invalid_records, process, profile, quality_report, valid_records
from plumbline.operators.checks import CHECKS
from plumbline.schema import PARTITION_COLUMN
from plumbline.sinks import append_failure, append_success, land
from plumbline.sources import Collection, load_collection

__all__ = [
    "MetricsCollector",
    "get_schema",
    "process_reviews",
    "read_reviews",
    "remove_accents",
    "save_dataframe",
    "save_metrics",
    "validate_ingest",
]

log = logging.getLogger(__name__)

process_reviews = process
get_schema = conform


def _today() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d")


def read_reviews(
    spark: SparkSession, landed_path: str, collection: Collection, load_date: str | None = None
) -> DataFrame:
    """The documents a run on ``load_date`` has to process: new ones, or all if nothing was landed before."""
    return load_collection(spark, collection, landed_path, load_date or _today()).documents


def validate_ingest(records: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, Any]]:
    """Valid rows, invalid rows (both lazy) and the check results."""
    rows = quality_report(profile(records)).collect()
    results: dict[str, Any] = {
        row["check"]: {"message": row["message"], "status": row["status"], "code": row["code"]} for row in rows
    }
    results["total_records"] = rows[0]["total_records"]
    return valid_records(records), invalid_records(records), results


def save_dataframe(
    df: DataFrame,
    path: str,
    label: str,
    schema: StructType | None = None,
    partition_column: str = PARTITION_COLUMN,
    compression: str = "snappy",
    load_date: str | None = None,
) -> bool:
    """Land a frame; True if rows were written. Errors are logged, not raised."""
    if not isinstance(df, DataFrame) or not path:
        log.error("nothing to save for %s: a frame and a path are needed", label)
        return False
    try:
        rows = land(df, path, load_date or _today(), schema, partition_column, compression)["rows"]
    except Exception:
        log.exception("saving %s rows to %s failed", label, path)
        return False
    log.info("saved %d %s rows to %s", rows, label, path)
    return rows > 0


def save_metrics(
    spark: SparkSession,
    metrics_type: str,
    path: str,
    error: Exception | str | None = None,
    client: str | None = None,
    metrics_data: DataFrame | dict | str | None = None,
) -> None:
    """Append a run document of type ``success`` or ``fail`` (in any case) to the run log."""
    kind = metrics_type.lower()
    if kind == "success":
        if metrics_data is None:
            raise ValueError("a success needs a document")
        append_success(spark, path, metrics_data)
    elif kind == "fail":
        append_failure(spark, path, error or "", client)
    else:
        raise ValueError("the type must be 'success' or 'fail'")


class MetricsCollector:
    """Brackets a run and makes its metrics document from frames and check results."""

    def __init__(self, spark: SparkSession, event_log: str | None = None):
        self.spark = spark
        self.event_log = event_log
        self.run = RunInfo(app="", type_client="", application_id=spark.sparkContext.applicationId)

    def start_collection(self) -> None:
        self.run.start()

    def end_collection(self) -> None:
        self.run.end()

    def parse_stage_metrics(self, report: str) -> dict[str, str]:
        reports = self.spark.range(1).select(F.col("id").alias("run"), F.lit(report).alias("report"))
        return {row["key"]: row["value"] for row in parse_stage_report(reports).collect()}

    def collect_metrics(
        self, valid_df: DataFrame, invalid_df: DataFrame, validation_results: dict[str, Any], id_app: str, type_client: str
    ) -> str:
        """The document as JSON text; both frames are counted in one job."""
        self.run.app, self.run.type_client = id_app, type_client
        if self.event_log is not None:
            lines = application_log(self.spark, self.event_log)
            self.run.stages = stage_totals(stage_metrics(lines, begin=self.run.started, end=self.run.ended))
        checks = {
            name: F.struct(
                F.lit(validation_results[name]["message"]).alias("message"),
                F.lit(validation_results[name]["status"]).alias("status"),
                F.lit(validation_results[name]["code"]).alias("code"),
            )
            for name in CHECKS
        }
        came_in = F.lit(validation_results["total_records"])
        counts = valid_df.agg(F.count(F.lit(1)).alias("valid"), F.lit(0).alias("invalid")).unionByName(
            invalid_df.agg(F.lit(0).alias("valid"), F.count(F.lit(1)).alias("invalid"))
        )
        summed = counts.agg(F.sum("valid").alias("valid"), F.sum("invalid").alias("invalid"))
        document = document_column(F.col("valid"), F.col("invalid"), came_in, checks, self.run)
        return summed.select(document.alias("document")).first()["document"]
