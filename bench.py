"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (optional)
a comma list of queries. Every query is run once to warm up and then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from newsloom.session import build_session

HEADLINE = [
    "top_keywords", "doc_keywords_topk", "term_idf", "clean_text", "tokens_unk", "oov_rate",
    "url_dedupe_first", "merge_articles", "new_articles_anti", "update_articles",
    "country_vote", "geo_resolve", "location_candidates", "gazetteer_last_wins",
    "rule_votes", "dutch_rule_votes", "vote_moments", "label_model_fit", "weak_label",
    "text_search", "preset_counts", "location_titles", "spotlight", "explore_keywords",
    "page_main_text", "page_listing_rows", "pages_to_articles", "enrich", "stream_ingest", "stream_exact_append",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from newsloom.catalog import QUERIES

    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "warm seconds over the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
