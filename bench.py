"""Benchmark: load the warehouse once, then time the headline queries on it.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.  ``value`` is the sum of the per-query seconds (each
query collected to the driver, best of BENCH_REPEATS runs, default 2);
``load_sec`` is the one-time load (fixture -> star -> recommendations ->
audits -> publish) that precedes them and is reported separately.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    # the ten golden queries
    "kpi_total", "category_margin", "top_customers", "yoy_trend", "loss_states", "subcategory_discount",
    "ship_mode_efficiency", "segment_quarterly", "top_product_per_category", "discount_tier_matrix",
    # metric layer / charts on the wide views
    "chart_annual_trend", "chart_ship_mode", "chart_discount_bubble", "chart_states_region", "chart_heavy_damage",
    # ranked and anomaly reports
    "top_products_report", "discount_destruction", "clearance_signature", "break_even_products",
    # recommendation view and audits
    "vds_recommendations", "audit_foreign_keys",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    from starbeam.plans.catalog import QUERIES
    from starbeam.session import local_session
    from starbeam.warehouse import STAGE_SECONDS, fixture

    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app="starbeam-bench")
    t0 = time.time()
    fixture(spark, sf_dir).star
    load = time.time() - t0
    times = {}
    for k in HEADLINE:
        best = None
        for _ in range(repeats):
            t = time.time()
            QUERIES[k](spark, sf_dir).collect()
            dt = time.time() - t
            best = dt if best is None else min(best, dt)
        times[k] = round(best, 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({
        "metric": "headline_query_seconds_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "load_sec": round(load, 3),
        "load_stages": {k: round(v, 3) for s in STAGE_SECONDS.values() for k, v in s.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
