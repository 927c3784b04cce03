"""Time the queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line.

Everything is run once to warm up, then three times, of which the median counts.
Queries run in full into a sink that discards rows, plan building included.
``stage_*`` are the one-time costs that the queries share: writing the joined lines
and the dimensions.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from shelfwise.plans.queries import queries
from shelfwise.plans.workspace import AS_OF, Workspace, workspace
from shelfwise.session import builder

RUNS = 3

# Queries whose result is kept for others.
STAGED = ("dim_product",)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(work: Callable[[], object]) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return statistics.median(times[1:])


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    shared = workspace(spark, folder, AS_OF)
    seconds = {
        "stage_retail_lines": median_seconds(lambda: Workspace(spark, folder, AS_OF).lines),
        "stage_dims": median_seconds(lambda: Workspace(spark, folder, AS_OF, lines=shared.lines).members),
    }
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        if name in STAGED:
            # Built anew each time; the queries after it find it stored.
            built = lambda: getattr(Workspace(spark, folder, AS_OF, lines=shared.lines), name)
            seconds[name] = median_seconds(built)
        else:
            seconds[name] = median_seconds(lambda: run(query(spark, folder)))
        print(f"{name}: {seconds[name]:.3f}", file=sys.stderr)

    print(
        json.dumps(
            {
                "metric": "total seconds: staging plus every query, warm medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 4) for k, v in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
