"""Sessions for jobs, tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app_name: str, **settings: str) -> SparkSession:
    """A session on UTC with the given settings.

    Tuning is left to ``spark-submit`` (see ``conf/landing.conf``): what is set
    here would win over it.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
