"""Benchmark: run the headline queries on $BENCH_SF_DIR and print one JSON line.

Each query runs to completion through a ``noop`` write (every row is
produced, nothing is collected to the driver).  A small warm-up run on
sf0.001 comes first and is not timed.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwise.plans import catalog  # noqa: E402
from cartwise.session import build_session  # noqa: E402

HEADLINE = [
    "frequency_profile",
    "companion_top1",
    "attribute_importance",
    "product_profiles",
    "similar_products",
    "age_candidates",
    "diversify",
    "upsize_pairs",
    "latest_purchase",
    "blended",
    "resolve_names",
    "fuzzy_names",
    "reply_products",
    "batch_numbers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session("cartwise-bench", f"local[{cpus}]", max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"})
    spark.sparkContext.setLogLevel("ERROR")

    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for n in ("frequency_profile", "blended", "companion_top1", "resolve_names"):
            catalog.QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()

    times = {}
    for n in names:
        t0 = time.perf_counter()
        catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
