"""What a run reports about itself."""

from plumbline.metrics.document import RunInfo, metrics_document
from plumbline.metrics.stages import application_log, parse_stage_report, stage_metrics, stage_totals

__all__ = ["RunInfo", "application_log", "metrics_document", "parse_stage_report", "stage_metrics", "stage_totals"]
