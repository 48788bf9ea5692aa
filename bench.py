"""Time the headline queries and print one JSON line.

Tables from $BENCH_SF_DIR, cores from $BENCH_CPUS. Each query runs once to warm
up and once timed; its whole result is computed and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

from vectorloom.plans.queries import QUERIES
from vectorloom.session import build_session

HEADLINE = (
    "text_search", "text_search_filtered", "retrieval_metrics", "vector_topk_multi", "vector_topk_single",
    "vector_topk_approx", "matryoshka_dims", "hash_encoder", "silver_clean", "bronze_ingest", "insert_if_absent",
    "medallion_batch", "stream_medallion", "atom_feed", "rss_feed", "unprocessed_antijoin", "recent_papers",
    "state_latest", "sorted_fetch", "quality_report", "quality_profile", "split_documents",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main(names) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = run(spark, name, folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
