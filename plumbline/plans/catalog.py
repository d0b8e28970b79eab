"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

The review collection is derived from whole tables, written once per session
and table folder, and then read like any other collection.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.metrics import RunInfo, metrics_document, parse_stage_report, stage_metrics
from plumbline.operators import (
    conform,
    duplicate_groups,
    duplicate_rows,
    flatten,
    invalid_records,
    normalize,
    null_profile,
    null_records,
    process,
    profile,
    quality_report,
    type_failures,
    valid_records,
)
from plumbline.operators.routing import REASON
from plumbline.plans.ingest import IngestJob, IngestResult, run_ingest
from plumbline.schema import COLUMNS, TARGET
from plumbline.sinks import append_failure, append_success, land, read_run_log
from plumbline.sources import Collection, day_mark, load_collection, read_landed, since
from plumbline.sources.review_events import review_documents
from plumbline.storage import shared_folder, store

APP = "app-x"
MARK = "2024-01-30T00:00:00"
FIRST_DAY, SECOND_DAY, THIRD_DAY = "20240129", "20240130", "20240131"
SKEWED_HOT_ROWS = 100

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """The folder ``write(path)`` filled, made once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = shared_folder(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def review_collection(spark: SparkSession, sf_dir: str) -> Collection:
    path = _once(spark, sf_dir, "reviews", lambda p: store(review_documents(spark, sf_dir), p))
    return Collection(APP, options={"path": path})


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(review_collection(spark, sf_dir).read(spark), APP)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Two load days: what was there on the first, the rest on the second."""

    def write(path: str) -> None:
        records = normalize(valid_records(_records(spark, sf_dir)))
        early = F.col("timestamp") < "2024-01-29"
        land(records.filter(early), path, FIRST_DAY, TARGET)
        land(records.filter(~early), path, SECOND_DAY, TARGET)

    return _once(spark, sf_dir, "landed", write)


def _scan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Collection("documents", options={"path": f"{sf_dir}/documents.parquet"}).read(spark)


def _load(spark: SparkSession, sf_dir: str, landed_path: str) -> DataFrame:
    load = load_collection(spark, review_collection(spark, sf_dir), landed_path, THIRD_DAY)
    mode, mark = F.lit(load.mode).alias("mode"), F.lit(load.mark).cast("string").alias("mark")
    return flatten(load.documents, APP).select("*", mode, mark)


def _skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all records share one key, a ninth has no key."""
    number = F.col("id").cast("bigint")
    third, ninth = number % 3 == 0, number % 9 == 1
    return _records(spark, sf_dir).withColumns(
        {
            "customer_id": F.when(third, "7").when(~ninth, F.col("customer_id")),
            "app_version": F.when(third, "1.0.0").otherwise(F.col("app_version")),
            "rating": F.when(third, "5").otherwise(F.col("rating")),
        }
    )


def _roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "roundtrip")
    land(normalize(valid_records(_records(spark, sf_dir))), path, SECOND_DAY, TARGET)
    return read_landed(spark, path)


def _document(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = RunInfo(app=APP, type_client="pf", application_id="run").start().end()
    return metrics_document(profile(_records(spark, sf_dir)), run)


def _document_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document taken apart again, without application id and times."""
    check = "struct<message: string, status: boolean, code: int>"
    share = "struct<count: bigint, percentage: double>"
    schema = f"""
        owner struct<sigla: string, projeto: string, layer_lake: string>,
        valid_data {share}, invalid_data {share}, total_records bigint, input_records bigint,
        validation_results struct<duplicate_check: {check}, null_check: {check}, type_consistency_check: {check}>,
        success_count int, error_count int, type_client string, source struct<app: string, search: string>
    """
    parsed = _document(spark, sf_dir).select(F.from_json("document", schema).alias("d")).select("d.*")
    return parsed.select(
        F.col("owner.layer_lake").alias("layer_lake"),
        F.col("valid_data.count").alias("valid_count"),
        F.col("valid_data.percentage").alias("valid_percentage"),
        F.col("invalid_data.count").alias("invalid_count"),
        F.col("invalid_data.percentage").alias("invalid_percentage"),
        "total_records",
        "input_records",
        F.col("validation_results.duplicate_check.code").alias("duplicate_code"),
        F.col("validation_results.null_check.message").alias("null_message"),
        F.col("validation_results.type_consistency_check.status").alias("type_status"),
        "success_count",
        "error_count",
        "type_client",
        F.col("source.app").alias("app"),
    )


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "run-log")
    append_success(spark, path, _document(spark, sf_dir))
    append_failure(spark, path, "source not reachable", "pf")
    append_failure(spark, path, "disk full")
    document = F.col("document")
    return read_run_log(spark, path).select(
        "metrics_type",
        F.coalesce(F.get_json_object(document, "$.type_client"), F.get_json_object(document, "$.client")).alias("client"),
        F.get_json_object(document, "$.total_records").alias("total_records"),
        F.get_json_object(document, "$.priority").alias("priority"),
        F.get_json_object(document, "$.error").alias("error"),
    )


def stage_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage report text per event."""
    lines = [
        F.lit(""),
        F.lit("Scheduling mode = FIFO"),
        F.concat(F.lit("Spark Context default degree of parallelism = "), F.col("event_id") % 64),
        F.lit(""),
        F.lit("Aggregated Spark stage metrics:"),
        F.concat(F.lit("numStages => "), F.col("event_id") % 7),
        F.concat(F.lit("  elapsedTime => "), F.col("user_id"), F.lit(" (0.5 s)  ")),
        F.concat(F.lit("stage = "), F.col("event_type"), F.lit(" = skipped")),
        F.concat(F.lit("kind => "), F.col("event_type")),
        F.concat(F.lit("numStages => "), F.col("event_id") % 5),
        F.lit("   "),
    ]
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.col("event_id").alias("run"), F.concat_ws("\n", *lines).alias("report"))


def _stage_report_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        # Several files, so that reading them is not one task.
        stage_reports(spark, sf_dir).write.option("maxRecordsPerFile", 10_000).parquet(path)

    return parse_stage_report(spark.read.parquet(_once(spark, sf_dir, "stage-reports", write)))


def task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log lines: a task end per line item, a job start per order, as JSON text."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    quantity = F.col("l_quantity").cast("bigint")
    metrics = F.struct(
        quantity.alias("Executor Run Time"),
        (quantity * 1000).alias("Executor CPU Time"),
        F.col("l_linenumber").cast("bigint").alias("JVM GC Time"),
        (quantity * F.col("l_linenumber")).alias("Peak Execution Memory"),
        F.lit(0).alias("Memory Bytes Spilled"),
        F.lit(0).alias("Disk Bytes Spilled"),
        F.struct(quantity.alias("Remote Bytes Read"), F.lit(10).alias("Local Bytes Read")).alias("Shuffle Read Metrics"),
        F.struct((quantity * 2).alias("Shuffle Bytes Written")).alias("Shuffle Write Metrics"),
        F.struct((quantity * 3).alias("Bytes Read"), quantity.alias("Records Read")).alias("Input Metrics"),
        F.struct((quantity * 4).alias("Bytes Written"), F.lit(1).alias("Records Written")).alias("Output Metrics"),
    )
    ends = lineitem.select(
        F.to_json(
            F.struct(
                F.lit("SparkListenerTaskEnd").alias("Event"),
                (F.col("l_orderkey") % 500).alias("Stage ID"),
                metrics.alias("Task Metrics"),
            )
        ).alias("value")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    start = F.struct(F.lit("SparkListenerJobStart").alias("Event"), F.col("o_orderkey").alias("Job ID"))
    starts = orders.select(F.to_json(start).alias("value"))
    return ends.unionByName(starts)


def _stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        # Packed files are read by one task each, so they are kept small.
        task_events(spark, sf_dir).write.option("maxRecordsPerFile", 1_000_000).text(path, compression="gzip")

    return stage_metrics(spark.read.text(_once(spark, sf_dir, "event-log", write)))


def ingest(spark: SparkSession, sf_dir: str) -> tuple[IngestJob, IngestResult]:
    """A whole run into new folders."""
    path = shared_folder(spark, "ingest")
    job = IngestJob(review_collection(spark, sf_dir), "pf", f"{path}/valid", f"{path}/runs", SECOND_DAY)
    return job, run_ingest(spark, job)


def _written_rows(spark: SparkSession, job: IngestJob) -> DataFrame:
    """Landed and quarantined rows with their outcome."""
    as_text = [F.col(name).cast("string").alias(name) for name in [*COLUMNS, "odate"]]
    landed = read_landed(spark, job.target).select(F.lit("valid").alias("outcome"), *as_text)
    layout = ", ".join(f"{name} string" for name in [*COLUMNS, REASON, "odate"])
    quarantine = spark.read.schema(layout).parquet(job.quarantine_path)
    return landed.unionByName(quarantine.select(F.col(REASON).alias("outcome"), *as_text))


def ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything one run wrote."""
    return _written_rows(spark, ingest(spark, sf_dir)[0])


def _ingest_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run, then an incremental one on the day after, which is done twice."""
    first, _ = ingest(spark, sf_dir)
    second = replace(first, load_date=THIRD_DAY)
    run_ingest(spark, second)
    run_ingest(spark, second)
    return _written_rows(spark, second)


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(process(review_collection(spark, sf_dir).read(spark), APP))


QUERIES = {
    "scan_full": _scan_full,
    "landed_read": lambda spark, sf: read_landed(spark, _landed(spark, sf)),
    "high_water_mark": lambda spark, sf: day_mark(read_landed(spark, _landed(spark, sf)), THIRD_DAY),
    "incremental_scan": lambda spark, sf: flatten(since(review_collection(spark, sf).read(spark), MARK), APP),
    "load_mode_full": lambda spark, sf: _load(spark, sf, shared_folder(spark, "nothing-landed")),
    "load_mode_incr": lambda spark, sf: _load(spark, sf, _landed(spark, sf)),
    "flatten_project": _records,
    "normalize_text": lambda spark, sf: normalize(_records(spark, sf)),
    "conform_schema": _conformed,
    "duplicate_groups": lambda spark, sf: duplicate_groups(_records(spark, sf)),
    "null_profile": lambda spark, sf: null_profile(_records(spark, sf)),
    "type_check": lambda spark, sf: type_failures(_records(spark, sf)),
    "quality_report": lambda spark, sf: quality_report(profile(_records(spark, sf))),
    "valid_records": lambda spark, sf: normalize(valid_records(_records(spark, sf))),
    "null_records": lambda spark, sf: normalize(null_records(_records(spark, sf))),
    "duplicate_rows": lambda spark, sf: normalize(duplicate_rows(_records(spark, sf), in_place=True)),
    "duplicate_rows_skewed": lambda spark, sf: duplicate_rows(
        _skewed(spark, sf), hot_rows=SKEWED_HOT_ROWS, in_place=True
    ),
    "duplicate_rows_merged": lambda spark, sf: duplicate_rows(
        _skewed(spark, sf), hot_rows=SKEWED_HOT_ROWS, strategy="merge", in_place=True
    ),
    "invalid_records": lambda spark, sf: normalize(invalid_records(_records(spark, sf), in_place=True)),
    "invalid_records_screened": lambda spark, sf: invalid_records(
        _skewed(spark, sf), None, SKEWED_HOT_ROWS, in_place=True
    ),
    "invalid_records_merged": lambda spark, sf: invalid_records(
        _skewed(spark, sf), None, SKEWED_HOT_ROWS, strategy="merge", in_place=True
    ),
    "partitioned_roundtrip": _roundtrip,
    "run_log_roundtrip": _run_log,
    "metrics_document": _document_columns,
    "stage_report_parse": _stage_report_parse,
    "stage_metrics": _stage_metrics,
    "ingest_run": ingest_run,
    "ingest_two_days": _ingest_two_days,
}
