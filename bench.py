"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local threads. Every query runs once to warm up and then
BENCH_RUNS times, fewer once it has taken LONG seconds; the median counts. Results go to a noop sink, so that all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

LONG = 30.0
HEADLINE = [
    "last3_agg", "last3_by_season", "current_season", "value_latest", "union_view", "in_ids", "totals_rollup", "recent_matches",
    "norm_key", "norm_name_fl", "parse_money", "outer_merge_wide", "processed_players", "gk_left_merge", "derived_metrics",
    "backfill_first", "resolve_exact", "resolve_breakdown", "crosswalk", "resolve_fuzzy_club", "rolling_avg", "rank_in_group",
    "standardise", "knn_one", "knn_exact", "value_opportunities_baseline", "quality_report", "fk_orphans", "describe",
    "partition_refresh", "page_links", "squad_rows", "merge_two_clubs", "knn_keepers", "resolve_fuzzy_global",
]


def main() -> None:
    from touchline.plans import catalogue
    from touchline.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.all_queries()
    wanted = sys.argv[1:] or HEADLINE
    times = {}
    for name in wanted:
        taken: list[float] = []
        # long queries vary less, so they are repeated less
        while len(taken) <= runs and (len(taken) < 2 or sum(taken) < LONG):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {times[name]} (first {taken[0]:.1f})", file=sys.stderr)
    from touchline.session import discard_scratch

    discard_scratch(spark)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
