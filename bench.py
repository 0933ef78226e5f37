"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed to completion through the ``noop`` sink (no rows are
collected to the driver); the time per query is the median of
$BENCH_REPEATS runs (default 3), after one untimed warm-up query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hirelens.plans.queries import QUERIES  # noqa: E402
from hirelens.session import build_session  # noqa: E402

HEADLINE = [
    "a1_job_counts_10m", "a2_skill_counts_30m", "a3_job_counts_sliding", "a4_skill_counts_sliding",
    "a6_job_facts_daily", "a7_skill_counts_daily", "a8_salary_stats_by_skill_month",
    "a9_company_hiring_by_month", "a10_skill_cooccurrence_weekly", "w2_skill_rank_overall",
    "w3_demand_trend_city", "k6_latest_snapshot", "k8_upsert_merge", "n2_n3_parse_salary_lineitem",
    "n5_filter_skills_documents", "x1_clean_text_documents", "k1_k2_pages_urls",
    "x9_x10_page_text_and_blocked", "l1_top_skills_latest_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or HEADLINE
    spark = build_session(f"local[{cpus}]", app="hirelens-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    # one untimed run so JIT / codegen warm-up is not charged to the first query
    QUERIES["k1_k2_pages_urls"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        fn, _ = QUERIES[name]
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
