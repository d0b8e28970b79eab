"""Whole runs."""

from plumbline.plans.ingest import IngestJob, IngestResult, run_ingest

__all__ = ["IngestJob", "IngestResult", "run_ingest"]
