"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The normalised tables are built first (``build_store``), as the reports run on
loaded tables.  Every query then runs once to warm up and ``BENCH_REPEATS``
times; its time is the median, rows fetched.  ``q@all`` is the same report
without a row limit.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from shelfmark.plans import queries as q
from shelfmark.plans.store import open_store
from shelfmark.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))

HEADLINE = {
    "simple_select": q.simple_select,
    "count_by_genre": q.count_by_genre,
    "games_with_developers": q.games_with_developers,
    "review_stats_by_game": q.review_stats_by_game,
    "developer_statistics": q.developer_statistics,
    "price_history_analysis": q.price_history_analysis,
    "multi_join_details": q.multi_join_details,
}


def seconds(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def main() -> None:
    spark = build_session(
        "shelfmark-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS if CPUS.isdigit() else "8",
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    store = open_store(spark, FOLDER)
    times = {"build_store": seconds(store.build_all)}
    for name, build in HEADLINE.items():
        for label, limit in ((name, 100), (f"{name}@all", None)):
            run = lambda: build(store, limit).toArrow()  # noqa: B023, E731
            run()
            times[label] = statistics.median(seconds(run) for _ in range(REPEATS))
    total = sum(t for label, t in times.items() if label != "build_store")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 4),
                "unit": "sec",
                "queries": {k: round(v, 4) for k, v in times.items()},
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
