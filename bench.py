"""Time every query on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

A query's time runs from its call to its last row, jobs that it runs by itself included, and is the
better of two runs; the whole ingest is run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.plans.queries import QUERIES
from millrace.session import build_session

ONCE = {"ingest_rerun"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        f"local[{cpus}]",
        "millrace-bench",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    spark.read.parquet(f"{folder}/orders.parquet").count()
    seconds = {n: round(min(run(n) for _ in range(1 if n in ONCE else 2)), 3) for n in names}
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(folder.rsplit("sf", 1)[-1]) if "sf" in folder else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
