"""Time the headline queries; prints one JSON line.

Every query runs in full (planning, stored intermediate tables and a sink that takes all
rows), each in the order listed, after one small job that starts the session.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from larkspur import build_session
from larkspur.plans.registry import QUERIES
from larkspur.session import frames_released, shared_folder

HEADLINE = (
    "word_totals", "top_words", "word_counts", "line_index", "unique_words",
    "log_status_counts", "response_code_share", "top_failed_endpoints", "daily_hosts_by_date",
    "not_found_by_hour", "product_ingest", "tokens_no_stop", "idf", "tfidf_weights",
    "inverted_similarity", "candidate_pairs", "cartesian_summary", "pair_similarity",
    "dup_similarity_avg", "quality_curve", "ratings_ingest", "titled_movie_stats",
    "popular_movies", "rmse", "mean_baseline_rmse", "als_rank_selection",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g",
                          # The tables are single small files.
                          spark__larkspur__scan__partitions=cpus,
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    # One machine, so any folder of it is shared by all tasks.
    if not shared_folder(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="larkspur-bench-"))
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        with frames_released():
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
