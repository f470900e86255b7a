"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores.
"""

import importlib
import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "flatten_deliveries",
    "match_player_registry",
    "dim_match",
    "fact_delivery",
    "fact_from_documents",
    "batting_scorecard",
    "bowling_scorecard",
    "team_match_summary",
    "player_season_stats",
    "upsert_manifest",
    "incremental_build",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scorebook-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Spares the driver a stack trace per column expression.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = importlib.import_module("__spark_entry__").queries()
    # Warms up scans, code generation and Python workers; not timed.
    spark.read.parquet(f"{folder}/events.parquet").write.format("noop").mode("overwrite").save()
    queries[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()

    seconds, failed = {}, {}
    optional = [name for name in queries if name.startswith("op")]
    for name in (*HEADLINE, *optional):
        start = time.perf_counter()
        try:
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        except Exception as error:  # one failure must not hide the other figures
            failed[name] = str(error).splitlines()[0][:300] if str(error) else type(error).__name__
            continue
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                **({"failed": failed} if failed else {}),
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
