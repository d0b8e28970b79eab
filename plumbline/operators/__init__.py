"""DataFrame to DataFrame operators."""

from plumbline.operators.checks import (
    duplicate_groups,
    null_profile,
    profile,
    quality_report,
    type_failures,
)
from plumbline.operators.conform import conform
from plumbline.operators.project import flatten, normalize, process
from plumbline.operators.routing import duplicate_rows, invalid_records, null_records, valid_records

__all__ = [
    "conform",
    "duplicate_groups",
    "duplicate_rows",
    "flatten",
    "invalid_records",
    "normalize",
    "null_profile",
    "null_records",
    "process",
    "profile",
    "quality_report",
    "type_failures",
    "valid_records",
]
