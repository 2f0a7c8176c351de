"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and print one JSON line.

Every query is run to its end through the no-op sink. The value is the sum of the best times after
one warm-up run, as the first run mostly measures class loading and compilation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlattice.plans import registry  # noqa: E402
from adlattice.session import build_session  # noqa: E402

HEADLINE = [
    "latest_listing", "cleaned_listings", "crawl_candidates", "master_upsert", "price_history", "price_changes_log",
    "snapshot_to_master", "idempotent_append", "key_violations", "clean_text", "text_chunks", "section_breaks",
    "keyword_scores", "aspect_scores", "percentile_by_position", "percentile_by_share", "top_per_aspect",
    "vector_topk", "search_ranked", "embedding_scores", "ann_topk", "search_texts", "cache_live",
    "page_fields", "marker_counts", "result_cards", "item_details", "stream_dedupe", "stream_price_changes",
    "nightly_scores", "aspect_scores_stored", "similar_listings", "staged_load", "stream_master",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("adlattice-bench", f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run = lambda query=registry.QUERIES[name]: query(spark, folder)
        seconds(run)
        times[name] = round(min(seconds(run) for _ in range(2)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
