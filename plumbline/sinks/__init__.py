"""Where records and run documents go."""

from plumbline.sinks.partitioned import land
from plumbline.sinks.run_log import append_failure, append_success, read_run_log

__all__ = ["append_failure", "append_success", "land", "read_run_log"]
