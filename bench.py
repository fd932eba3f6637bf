"""Time every registered query and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores, ``BENCH_RUNS``
the timed runs per query, of which the median counts, and ``BENCH_QUERIES`` a
comma-separated choice of queries. Results go to Spark's noop sink, so all rows and
columns are computed and none are brought to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import QUERIES  # noqa: E402
from tidemark import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or sorted(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(key: str) -> float:
        started = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    # The first queries of a JVM pay for class loading and compilation.
    for key in ("daily_close_pivot", "stg_fx", "conform_full_outer"):
        run(key)
    seconds = {key: round(statistics.median(run(key) for _ in range(runs)), 3) for key in chosen}
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
