"""Benchmark: headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is built and fully executed into the ``noop`` sink (every row is
computed, nothing is collected). Before timing, the headline queries run
once on the tiny sf0.001 tables so that JIT compilation and Python worker
start-up are not charged to whichever query happens to run first; the
timed runs then read the benchmark scale from scratch. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revline.queries import CATALOGUE  # noqa: E402
from revline.session import drop_scratch, get_session  # noqa: E402

HEADLINE = [
    "q_recommendations",
    "q_recommendations_min30",
    "q_item_sentiment_stats",
    "q_stage_reviews",
    "q_fact_reviews",
    "q_sentiment_by_tag",
    "q_item_stats_all",
    "q_dq_report",
    "q_keep_first",
    "q_newest_k",
    "q_sentiment_documents",
    "q_landing_roundtrip",
    "q_pipeline_recommendations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    # warm-up on different, tiny data: JIT, codegen caches, Python workers
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            CATALOGUE[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        CATALOGUE[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
