"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of tables), BENCH_CPUS (threads), BENCH_QUERIES (comma-separated
names, default all). Each query is run in full into a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewatch.session import build_session  # noqa: E402
from workload.queries import REGISTERED  # noqa: E402


def run(query, spark, sf):
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(REGISTERED)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's code paths once, so that the first query is not charged for them
    run(REGISTERED["classified_drift"], spark, sf)
    times = {name: round(run(REGISTERED[name], spark, sf), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "registered queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
