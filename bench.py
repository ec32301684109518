"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from marquee.session import session
from marquee.workload.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = os.environ.get("BENCH_QUERIES", "").split() or [
    "clean_text",
    "tokenise",
    "sentiment_doc",
    "sentiment_verdict",
    "review_stats",
    "parse_date",
    "explode_distinct",
    "dim_keys",
    "bridge",
    "pk_violations",
    "fk_orphans",
    "match_review",
    "rank_lookup",
    "star_schema",
    "table_counts",
    "names_of_item",
    "items_of_name",
    "search_title",
    "search_actor",
    "search_order",
    "text_search",
    "tfidf",
    "cosine",
    "similar_title",
    "similar_topk",
    "detail_flat",
    "page_blocks",
    "frontier",
]


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(seconds(spark, name) for _ in range(RUNS)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
