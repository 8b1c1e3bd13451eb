"""Time the registered queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (comma separated)
restricts the run. Each query is built and run to its last row; the result goes to the noop
sink, so that every column of every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyframe.plans.queries import queries  # noqa: E402
from tallyframe.session import build_session  # noqa: E402


def run(spark, query, sf_dir: str) -> float:
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    scratch = tempfile.mkdtemp(prefix="tallyframe-bench-")
    spark = build_session(
        "tallyframe-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": f"file://{scratch}",
            # Little data in many folders takes its time for the files: use all cores for it here.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {name: query for name, query in queries().items() if not wanted or name in wanted}
    # One run outside of the clock starts the executor threads and compiles the common code.
    run(spark, queries()["sales_mart"], sf_dir)
    seconds = {name: round(run(spark, query, sf_dir), 3) for name, query in chosen.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)


if __name__ == "__main__":
    main()
