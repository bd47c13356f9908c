"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from rankloom.plans import views
from rankloom.plans.registry import QUERIES
from rankloom.session import get_session

HEADLINE = (
    "first_wins_dedupe", "dense_ids", "html_extract", "robots_gate", "stopword_filter", "vocabulary_stem",
    "postings_plain", "postings_standard", "posting_text_export", "term_stats", "pagerank_fixed",
    "pagerank_converged", "frontier_bfs", "topk", "boolean_rank", "sentence_snippet", "fragment_snippet",
    "batch_search", "batch_search_requests", "json_pointer_columns",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    # Searches run on a built index, as they do in use; building it is timed on its own.
    timed("build_index", lambda: views.index(spark, sf_dir))
    timed("rank_documents", lambda: views.index(spark, sf_dir, with_rank=True))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
