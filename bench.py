"""Headline queries, timed. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from feedkit import catalog
from feedkit.session import local_session

HEADLINE = (
    "completions_enrich",
    "unique_course_family",
    "transfer_route",
    "transfer_survey",
    "students_late_or_open",
    "person_standardize_form",
    "employment_from_form",
    "person_match_route",
    "duplicate_identity",
    "completions_validate_person",
    "completions_newest_sheet",
    "delta_by_key",
    "delta_by_hash",
    "hash_diff_insert",
    "join_star",
    "join_or",
    "rn_earliest",
    "rn_latest_multi",
    "group_concat_set",
    "flatten_sheet",
)


def run(spark, path: str, name: str, repeats: int) -> float:
    fn = catalog.queries()[name]
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        fn(spark, path).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "feedkit-bench")
    spark.read.parquet(f"{path}/orders.parquet").count()
    queries = {n: round(run(spark, path, n, repeats), 3) for n in names}
    total = round(sum(queries.values()), 3)
    sf = os.path.basename(path.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": queries, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
