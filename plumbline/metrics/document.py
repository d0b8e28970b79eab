"""The metrics document of a run, one row of JSON."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.checks import verdicts


@dataclass
class RunInfo:
    """What the document says about the run itself."""

    app: str
    type_client: str
    application_id: str = ""
    search: str = "parquet"
    sigla: str = ""
    projeto: str = "reviews"
    layer_lake: str = "bronze"
    stages: dict[str, str] = field(default_factory=dict)
    started: datetime | None = None
    ended: datetime | None = None

    def start(self) -> RunInfo:
        self.started = datetime.now(timezone.utc)
        return self

    def end(self) -> RunInfo:
        self.ended = datetime.now(timezone.utc)
        return self

    @property
    def minutes(self) -> float:
        if self.started is None or self.ended is None:
            raise ValueError("start() and end() must be called before the document is made")
        return (self.ended - self.started).total_seconds() / 60

    @property
    def memory_used(self) -> float | None:
        """Peak execution memory of a task in MB, if stage metrics were collected."""
        peak = self.stages.get("peak_memory_bytes")
        return None if peak is None else int(peak) / 2**20


def _share(part: Column, total: Column) -> Column:
    share = part.cast("double") / total.cast("double") * 100
    return F.struct(part.alias("count"), F.when(total > 0, share).otherwise(F.lit(0.0)).alias("percentage"))


def _stages(stages: dict[str, str]) -> Column:
    if not stages:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(item) for pair in stages.items() for item in map(str, pair)])


def document_column(valid: Column, invalid: Column, came_in: Column, checks: dict[str, Column], run: RunInfo) -> Column:
    """The document as JSON text, from the row counts and a verdict struct per check.

    ``total_records`` is valid + invalid and counts a duplicate on both sides,
    ``input_records`` is the number of rows that came in.
    """
    total_time = f"{run.minutes:.2f} min"
    passed = sum((check["status"].cast("int") for check in checks.values()), F.lit(0))
    stamp = "%Y-%m-%d %H:%M:%S"
    owner = F.struct(
        F.lit(run.sigla).alias("sigla"), F.lit(run.projeto).alias("projeto"), F.lit(run.layer_lake).alias("layer_lake")
    )
    times = F.struct(
        F.lit(run.started.strftime(stamp)).alias("start"), F.lit(run.ended.strftime(stamp)).alias("end")
    )
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="milliseconds") + "Z"
    # The names of the fields.
    return F.to_json(
        F.struct(
            F.lit(run.application_id).alias("application_id"),
            owner.alias("owner"),
            _share(valid, valid + invalid).alias("valid_data"),
            _share(invalid, valid + invalid).alias("invalid_data"),
            (valid + invalid).alias("total_records"),
            came_in.alias("input_records"),
            F.lit(total_time).alias("total_processing_time"),
            F.lit(run.memory_used).alias("memory_used"),
            _stages(run.stages).alias("stages"),
            F.struct(*[verdict.alias(name) for name, verdict in checks.items()]).alias("validation_results"),
            passed.alias("success_count"),
            (F.lit(len(checks)) - passed).alias("error_count"),
            F.lit(run.type_client.upper()).alias("type_client"),
            F.struct(F.lit(run.app).alias("app"), F.lit(run.search).alias("search")).alias("source"),
            times.alias("_ts"),
            F.lit(now).alias("timestamp"),
        )
    )


def metrics_document(profiled: DataFrame, run: RunInfo) -> DataFrame:
    """The document of a run from its profile row; everything is computed in the plan of that row."""
    total, nulls, duplicates = F.col("total_records"), F.col("null_rows"), F.col("duplicate_rows")
    document = document_column(total - nulls, nulls + duplicates, total, verdicts(), run)
    return profiled.select(document.alias("document"))
