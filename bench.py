"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Every query is computed in full and its rows are discarded, so that neither the
driver nor a sink is part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sectorlens.registry import catalog
from sectorlens.session import local_session

HEADLINE = (
    "energy_io", "energy_io_two_factor", "map_ready", "generation_map", "monthly_series",
    "seasonal_forecast", "seasonal_model_forecast", "actuals_plus_forecast",
    "verb_line_filter", "strip_boilerplate", "page_text", "token_windows", "segment_summaries",
    "group_mean_broadcast", "dedupe_first", "company_text_rollup", "pack_by_chars", "pack_by_words",
    "company_summaries", "keywords_company", "keywords_sector", "sentiment_scores",
    "tfidf_weights", "tfidf_topk", "rag_prompts", "vector_topk", "adjacent_similarity",
    "semantic_segments", "final_dataset",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, "sectorlens-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Start the Python workers and the code cache before the clock runs.
    spark.range(1000).repartition(4).mapInPandas(lambda it: it, "id long").count()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total wall time of the headline queries",
                      "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
