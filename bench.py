"""Time the headline queries and print one line of JSON.

`BENCH_SF_DIR` names the folder of test tables, `BENCH_CPUS` the cores. Each
query is run once to warm up and then three times; the median counts. Results
are written to the `noop` sink, so every row is produced and none is collected.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from feedmill import catalog

HEADLINE = [
    "applied_ops",
    "classified",
    "gate_v8",
    "change_feed",
    "feed_v7",
    "feed_dynamic",
    "feed_long_history",
    "order_feed",
    "document_feed",
    "scn_blocks",
    "scn_orders",
    "settings_latest",
    "log_roundtrip",
    "tail",
    "current_state",
    "snapshot_diff",
    "scn_gaps",
    "payload_decoded",
    "volume_hourly",
    "feed_stream",
    "feed_stream_batches",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = session(cpus)
    times = {}
    for name in HEADLINE:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(rounds)), 3)
    n_ops = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "feed_ops_per_second": round(n_ops / times["change_feed"]),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
