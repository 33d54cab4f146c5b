"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each
query writes all its rows to Spark's "noop" sink and runs over everything; the
label propagation of the news feed runs with all seeds over the given folder.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from ripple.plans import registry
from ripple.session import prepare

REGISTERED = (
    "weighted_edges", "degree_table", "social_rank", "friend_feed", "wall_feed", "friend_expand_visible",
    "friends_online", "friend_state", "profile_latest", "room_state", "posts_append", "keyword_index",
    "news_search", "stream_friend_state", "news_feed",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("bench") \
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g") \
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: registry.queries()[name] for name in REGISTERED}
    prepare(spark).read.parquet(f"{folder}/nation.parquet").count()     # start-up is not timed
    times = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
