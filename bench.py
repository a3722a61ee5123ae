"""Time the registered queries and print one JSON line.

Each query is built and run to the end into the no-op sink; the figure is the median of the runs
after one warm-up. BENCH_QUERIES=all times every registered query, or name some, comma-separated.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from convivio.plans.catalog import REGISTRY
from convivio.session import build_session

HEADLINE = [
    "f3_key_range", "j1_user_posts", "j2_social_stats", "j2_social_stats_distinct", "j4_shard_matrix",
    "j5_foreign_keys", "j6_cascade_delete", "a2_distinct_counts", "a3_daily_posts", "a5_partition_distribution",
    "a7_sample_stats", "a10_mode_comparison", "w1_keep_latest_likes", "w2_number_likes", "t1_user_feed",
    "t2_all_feeds", "t3_latest", "m1_insert_ignore", "m2_upsert", "m4_counter_drift", "m7_follow_log",
    "m7_follow_counters", "m8_like_counters", "m9_transaction_fold", "m10_saga_counters", "m11_outbox_events",
    "m12_constraint_audit", "r1_outbox_projection", "g2_posts", "g4_followers", "g5_likes", "g8_fk_sample",
]


def run_once(spark, name, folder) -> float:
    began = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(REGISTRY) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run_once(spark, name, folder)
        times[name] = round(statistics.median(run_once(spark, name, folder) for _ in range(repeats)), 3)
    spark.stop()
    print(json.dumps({"metric": "total_median_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
