"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to a sink that evaluates every column and keeps nothing; a small warm-up
query before them pays for the start of the JVM's code paths.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "scorecard",
    "confusion_by_group",
    "count_over_union",
    "running_count_in_file_order",
    "pivot_last_value",
    "join_feature_tables_outer",
    "panel_full_stats",
    "panel_number_stats",
    "panel_digit_numbers",
    "value_target_mean",
    "lag_match_best",
    "lag_match_cascade",
    "span_sentence_features",
    "syntactic_onehot",
    "join_mention_pairs",
    "deptree_features",
    "normalise_starred_text",
    "token_dictionary",
    "token_window",
    "embedding_assemble",
    "blend_weighted",
    "pair_compression_distance",
    "bitmask_sum",
    "scan_jsonl_nested",
    "feature_assembly",
]


def main() -> None:
    from lagloom.plans import catalog
    from lagloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=str(2 * int(cpus)),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"), spark__ui__showConsoleProgress="false", spark__sql__files__maxPartitionBytes="2m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["panel_basic_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
                "queries": took, "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
