"""``spark-submit ingest_reviews.py``: land one collection for one client type."""

from __future__ import annotations

import argparse
import logging
import sys

from plumbline.plans import IngestJob, run_ingest
from plumbline.session import session
from plumbline.sources import Collection


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("collection", help="name of the collection")
    parser.add_argument("type_client", help="client segment, e.g. pf or pj")
    parser.add_argument("--base", required=True, help="folder of the landed tables")
    parser.add_argument("--run-log", required=True, help="folder of the run log")
    parser.add_argument("--format", default="parquet", help="source format, e.g. a document store connector")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="source option")
    parser.add_argument("--schema", help="source schema as DDL, spares the source its inference")
    parser.add_argument("--load-date", help="yyyyMMdd, default today")
    parser.add_argument("--event-log", help="event log, or folder of logs, to report stage metrics from")
    parser.add_argument("--work", help="folder all executors share; default spark.checkpoint.dir")
    return parser.parse_args(arguments)


def main(arguments: list[str]) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s - %(levelname)s - %(message)s")
    given = parse(arguments)
    options = dict(option.split("=", 1) for option in given.option)
    when = {"load_date": given.load_date} if given.load_date else {}
    job = IngestJob(
        collection=Collection(given.collection, given.format, options, given.schema),
        type_client=given.type_client,
        target=f"{given.base.rstrip('/')}/{given.collection}_{given.type_client}",
        run_log=given.run_log,
        event_log=given.event_log,
        **when,
    )
    work = {"spark.checkpoint.dir": given.work} if given.work else {}
    spark = session(f"landing {given.collection}", **work)
    try:
        if not spark.sparkContext.master.startswith("local") and not spark.conf.get("spark.checkpoint.dir", ""):
            raise SystemExit("--work or spark.checkpoint.dir must name a folder that all executors share")
        result = run_ingest(spark, job)
        logging.info(
            "%s load: %d rows landed (%d without a numeric rating), %d quarantined",
            result.mode,
            result.landed_rows,
            result.unrated_rows,
            result.quarantined_rows,
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
