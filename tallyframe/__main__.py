"""``spark-submit``-able job: process what has landed since the last run.

The database is named by ``--jdbc-url`` and ``--jdbc-driver``; user and password are read from
``TALLYFRAME_JDBC_USER`` and ``TALLYFRAME_JDBC_PASSWORD``.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from tallyframe.plans.batch import Database, Layout, RunReport, load_dimensions, run_batch
from tallyframe.session import build_session


def main(arguments: Sequence[str] | None = None) -> RunReport:
    parser = argparse.ArgumentParser(prog="tallyframe", description=__doc__)
    parser.add_argument("--landing", required=True, help="folder with the sales files")
    parser.add_argument("--store", required=True, help="root of fact, marts and ledger; shared by all executors")
    parser.add_argument("--jdbc-url", required=True, help="database with the dimension and mart tables")
    parser.add_argument("--jdbc-driver", required=True, help="driver class")
    parser.add_argument("--on-interrupted", choices=("rerun", "fail"), default="rerun")
    parser.add_argument("--run-epoch-ms", type=int, help="number of the run, by default the current second")
    parser.add_argument("--no-mart-tables", action="store_true", help="write the marts to files only")
    options = parser.parse_args(arguments)

    properties = {"driver": options.jdbc_driver}
    for key, variable in (("user", "TALLYFRAME_JDBC_USER"), ("password", "TALLYFRAME_JDBC_PASSWORD")):
        if variable in os.environ:
            properties[key] = os.environ[variable]
    database = Database(options.jdbc_url, properties)

    spark = build_session("tallyframe")
    layout = Layout(options.store)
    report = run_batch(
        spark,
        options.landing,
        layout,
        load_dimensions(spark, database, layout),
        run_epoch_ms=options.run_epoch_ms,
        on_interrupted=options.on_interrupted,
        database=None if options.no_mart_tables else database,
    )
    print(report)
    return report


if __name__ == "__main__":
    # New files of which none was good are a failure of the delivery.
    raise SystemExit(3 if main().status == "rejected" else 0)
