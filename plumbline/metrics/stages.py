"""Stage metrics: from a textual report, and from Spark's own event log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.storage import child_names

# The report line to skip and the separators between key and value.
_SKIPPED_LINE = "Scheduling mode"
_SEPARATORS = " => | = "

# White space as the line breaks and margins of a report use it.
_MARGIN = " \t\n\r\x0b\x0c"

# The parts of a task-end event that are read.
_TASK_END = "SparkListenerTaskEnd"
_EVENT = """
    `Event` string,
    `Stage ID` bigint,
    `Task Info` struct<`Launch Time`: bigint>,
    `Task Metrics` struct<
        `Executor Run Time`: bigint,
        `Executor CPU Time`: bigint,
        `JVM GC Time`: bigint,
        `Peak Execution Memory`: bigint,
        `Memory Bytes Spilled`: bigint,
        `Disk Bytes Spilled`: bigint,
        `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>,
        `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>,
        `Output Metrics`: struct<`Bytes Written`: bigint, `Records Written`: bigint>
    >
"""


def application_log(spark: SparkSession, path: str, application_id: str | None = None) -> DataFrame:
    """Lines of one application's event log: a log file, or the application's log in a folder of logs.

    ``application_id`` defaults to the session's own. Jobs that ran in the
    application at the same time are part of its log.
    """
    application_id = application_id or spark.sparkContext.applicationId
    names = child_names(spark, path)
    if names == [path.rstrip("/").rsplit("/", 1)[-1]]:
        return spark.read.text(path)
    logs = [name for name in names if name.removeprefix("eventlog_v2_").split(".")[0] == application_id]
    if not logs:
        raise ValueError(f"no event log of {application_id} in {path}")
    return spark.read.text([f"{path.rstrip('/')}/{name}" for name in logs])


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_MARGIN))


def parse_stage_report(reports: DataFrame, run: str = "run", report: str = "report") -> DataFrame:
    """Key and value of every report line that has exactly the two; the last line of a key wins.

    ``reports`` holds one report text per run, next to a ``run`` column. Blank
    lines and the scheduling mode line are skipped. A report is taken apart
    inside its row, nothing is shuffled.
    """
    lines = F.filter(F.split(_strip(F.col(report)), "\n"), lambda line: ~F.startswith(line, F.lit(_SKIPPED_LINE)))
    parts = F.filter(F.transform(lines, lambda line: F.split(_strip(line), _SEPARATORS)), lambda part: F.size(part) == 2)
    pairs = F.transform(parts, lambda part: F.struct(_strip(part[0]).alias("key"), _strip(part[1]).alias("value")))
    # The outer form: the plain one would have every report parsed once more, to test for emptiness.
    numbered = reports.select(run, pairs.alias("pairs")).select(
        run, F.reverse(F.col("pairs.key")).alias("keys_from_end"), F.posexplode_outer("pairs").alias("position", "pair")
    )
    last = F.size("keys_from_end") - F.array_position("keys_from_end", F.col("pair.key"))
    return numbered.filter(F.col("position") == last).select(run, "pair.key", "pair.value")


def stage_metrics(
    log_lines: DataFrame, line: str = "value", begin: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Per stage totals of the task-end events in event log lines, as ``spark.read.text`` gives them.

    ``begin`` and ``end`` bracket the tasks by launch time, to tell one run from
    the rest of an application. Other events are skipped before any JSON is parsed.
    """
    events = log_lines.filter(F.contains(line, F.lit(_TASK_END))).select(F.from_json(line, _EVENT).alias("e"))
    events = events.filter(F.col("e.Event") == _TASK_END)
    launched = F.col("e.Task Info.Launch Time")
    if begin is not None:
        events = events.filter(launched >= _millis(begin))
    if end is not None:
        events = events.filter(launched <= _millis(end))
    task = F.col("e.Task Metrics")
    return (
        events.groupBy(F.col("e.Stage ID").alias("stage_id"))
        .agg(
            F.count(F.lit(1)).alias("tasks"),
            F.sum(task["Executor Run Time"]).alias("run_time_ms"),
            F.sum(task["Executor CPU Time"]).alias("cpu_time_ns"),
            F.sum(task["JVM GC Time"]).alias("gc_time_ms"),
            F.max(task["Peak Execution Memory"]).alias("peak_memory_bytes"),
            F.sum(task["Memory Bytes Spilled"]).alias("memory_spilled_bytes"),
            F.sum(task["Disk Bytes Spilled"]).alias("disk_spilled_bytes"),
            F.sum(
                task["Shuffle Read Metrics"]["Remote Bytes Read"] + task["Shuffle Read Metrics"]["Local Bytes Read"]
            ).alias("shuffle_read_bytes"),
            F.sum(task["Shuffle Write Metrics"]["Shuffle Bytes Written"]).alias("shuffle_write_bytes"),
            F.sum(task["Input Metrics"]["Records Read"]).alias("records_read"),
            F.sum(task["Input Metrics"]["Bytes Read"]).alias("bytes_read"),
            F.sum(task["Output Metrics"]["Records Written"]).alias("records_written"),
            F.sum(task["Output Metrics"]["Bytes Written"]).alias("bytes_written"),
        )
    )


def _millis(time: datetime) -> int:
    return int(time.timestamp() * 1000)


def stage_totals(stages: DataFrame) -> dict[str, str]:
    """The totals over all stages as the flat text map a metrics document carries."""
    sums = [name for name in stages.columns if name not in ("stage_id", "peak_memory_bytes")]
    row = stages.agg(
        F.count(F.lit(1)).alias("stages"),
        *[F.sum(name).alias(name) for name in sums],
        F.max("peak_memory_bytes").alias("peak_memory_bytes"),
    ).first()
    return {name: str(value) for name, value in row.asDict().items() if value is not None}
