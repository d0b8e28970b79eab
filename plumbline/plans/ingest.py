"""The landing run: read, check, route, land, record.

The source is read once, whatever its format: its records are folded, which is
most of the work and done once for a row, and stored. So every pass sees the same
rows. Passes over the stored records, whatever their number:

1. the three key columns, combined on the map side -> duplicate groups, stored;
2. all columns, map only -> valid rows landed, row counters observed on the way;
3. all columns -> quarantine: rows with a NULL and rows that match a stored group.
   Keys alone are joined with the groups; a screen of fixed size then tells the
   rows in place, and only the few it can not tell are moved.

Nothing is cached on executors; what was stored for the run is deleted with it,
also if it fails.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.metrics.document import RunInfo, metrics_document
from plumbline.metrics.stages import application_log, stage_metrics, stage_totals
from plumbline.operators.checks import duplicate_groups, group_counters, quality_report, row_counters
from plumbline.operators.conform import conform
from plumbline.operators.project import process
from plumbline.operators.routing import HOT_ROWS, invalid_records, valid_records
from plumbline.schema import PARTITION_COLUMN, TARGET
from plumbline.sinks.partitioned import land
from plumbline.sinks.run_log import JobLabels, append_failure, append_success
from plumbline.sources.collection import Collection, load_collection
from plumbline.storage import delete_folder, path_exists, shared_folder, store

log = logging.getLogger(__name__)

# A quarantine of at least this share of the rows gives files of a useful size as it is, and is not shuffled.
GATHERED_SHARE = 0.1


@dataclass(frozen=True)
class IngestJob:
    collection: Collection
    type_client: str
    target: str
    run_log: str
    load_date: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y%m%d"))
    quarantine: str | None = None
    hot_rows: int = HOT_ROWS
    event_log: str | None = None
    labels: JobLabels = JobLabels()

    def __post_init__(self) -> None:
        # Load dates are compared as text, so they must have one form.
        if datetime.strptime(self.load_date, "%Y%m%d").strftime("%Y%m%d") != self.load_date:
            raise ValueError(f"load date {self.load_date!r} is not yyyyMMdd")

    @property
    def quarantine_path(self) -> str:
        return self.quarantine or f"{self.target.rstrip('/')}_invalid"


@dataclass(frozen=True)
class IngestResult:
    mode: str
    mark: str | None
    landed_rows: int
    unrated_rows: int
    quarantined_rows: int
    profile: DataFrame
    report: DataFrame
    document: DataFrame


def _stored(df: DataFrame, path: str) -> DataFrame:
    store(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _one_row(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    return spark.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in values.items()])


def _ingest(spark: SparkSession, job: IngestJob, work: str) -> IngestResult:
    run = RunInfo(
        app=job.collection.name,
        type_client=job.type_client,
        application_id=spark.sparkContext.applicationId,
        search=job.collection.format,
    ).start()
    load = load_collection(spark, job.collection, job.target, job.load_date)
    log.info("%s load of %s, mark %s", load.mode, job.collection.name, load.mark)
    records = _stored(process(load.documents, job.collection.name), f"{work}/records")
    groups = _stored(duplicate_groups(records), f"{work}/duplicate_groups")
    counted = groups.agg(*[column.alias(name) for name, column in group_counters().items()]).first().asDict()

    # Observed below the filter: the counters see every row that came in.
    seen = Observation()
    counters = row_counters(records)
    observed = records.observe(seen, *[column.alias(name) for name, column in counters.items()])
    landed = land(
        valid_records(observed),
        job.target,
        job.load_date,
        schema=TARGET,
        counters={"unrated": F.count_if(F.col("rating").isNull())},
    )
    counts = {name: seen.get.get(name, 0) for name in counters} | counted
    if landed["rows"] != counts["total_records"] - counts["null_rows"]:
        raise RuntimeError(f"landed {landed['rows']} rows of {counts}")

    if not landed["rows"] and path_exists(spark, day := f"{job.target}/{PARTITION_COLUMN}={job.load_date}"):
        # An earlier run of this load date had valid rows, this one has none.
        conform(valid_records(records), TARGET).limit(0).write.mode("overwrite").parquet(day)

    quarantined = {"rows": 0}
    expected = counts["null_rows"] + counts["duplicate_rows"]
    if expected:
        invalid = invalid_records(records, groups, job.hot_rows, in_place=True)
        if expected < GATHERED_SHARE * counts["total_records"]:
            # A few rows from every input split: adaptive execution gathers them into files of a useful size.
            invalid = invalid.hint("rebalance")
        quarantined = land(invalid, job.quarantine_path, job.load_date)
        if quarantined["rows"] != expected:
            raise RuntimeError(f"quarantined {quarantined['rows']} rows, {expected} expected")
    elif path_exists(spark, day := f"{job.quarantine_path}/{PARTITION_COLUMN}={job.load_date}"):
        # An earlier run of this load date had invalid rows, this one has none.
        invalid_records(records, groups).limit(0).write.mode("overwrite").parquet(day)

    run.end()
    if job.event_log is not None:
        lines = application_log(spark, job.event_log)
        run.stages = stage_totals(stage_metrics(lines, begin=run.started, end=run.ended))
    profiled = _one_row(spark, counts)
    document = metrics_document(profiled, run)
    append_success(spark, job.run_log, document)
    return IngestResult(
        mode=load.mode,
        mark=load.mark,
        landed_rows=landed["rows"],
        unrated_rows=landed["unrated"],
        quarantined_rows=quarantined["rows"],
        profile=profiled,
        report=quality_report(profiled),
        document=document,
    )


def run_ingest(spark: SparkSession, job: IngestJob) -> IngestResult:
    """Run the job; a failure is recorded in the run log and raised.

    If the record cannot be written either, that is logged: the failure of the
    run itself is what is raised.
    """
    work = None
    try:
        work = shared_folder(spark, f"{job.collection.name}-{job.load_date}")
        return _ingest(spark, job, work)
    except Exception as error:
        log.exception("ingest of %s failed", job.collection.name)
        try:
            append_failure(spark, job.run_log, error, job.type_client, job.labels)
        except Exception:
            log.exception("the failure could not be recorded in %s", job.run_log)
        raise
    finally:
        if work is not None:
            delete_folder(spark, work)
