"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs once to warm the JVM and is then timed over its complete result.
"""

from __future__ import annotations

import json
import os
import time

from threadlens.plans.table_queries import QUERIES
from threadlens.session import local_session

HEADLINE = (
    "clean_text",
    "token_counts_video",
    "token_stats_video",
    "token_stats_channel",
    "tfidf_video",
    "tfidf_channel",
    "tfidf_bigrams",
    "tfidf_stemmed",
    "keyword_summary_video",
    "corpus_df",
    "tfidf_video_corpus",
    "distinctive_keywords",
    "channel_report",
    "flatten_comment_pages",
    "latest_runs",
    "upsert_refs",
)


def timed(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    seconds = {}
    for name in HEADLINE:
        timed(QUERIES[name], spark, folder)
        seconds[name] = round(timed(QUERIES[name], spark, folder), 3)
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
