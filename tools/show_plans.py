"""Print the physical plans of representative queries as Markdown.

usage: python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SHOWN = {
    "category_margin": "GQ-02: fact rolled up on product_key (partial + final aggregate) before the dimension join",
    "ship_mode_efficiency": "GQ-07: COUNT(DISTINCT) expands to (group, order_id) shuffles; two role-played date joins",
    "top_product_per_category": "GQ-09: RANK = 1 becomes a partial WindowGroupLimit before the category shuffle",
    "chart_heavy_damage": "C13: the tier filter reaches the Parquet scan as a range predicate on discount",
    "chart_revenue_by_region": "C4: only the geography dimension is joined (metric-layer join pruning)",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from starbeam.functions.dates import date_filter
    from starbeam.plans import golden as GQ
    from starbeam.plans.metrics import CHARTS
    from starbeam.session import local_session
    from starbeam.warehouse import fixture

    spark = local_session()
    star = fixture(spark, sf_dir).star
    fns = {**GQ.GOLDEN, **CHARTS}
    print("# Physical plans\n")
    print(f"Generated by `tools/show_plans.py` on {dt.date.today()} over `{sf_dir}` (the published star on disk).\n")
    for key, note in SHOWN.items():
        print(f"## {key}\n\n{note}.\n\n```")
        print(fns[key](star)._jdf.queryExecution().executedPlan().toString().rstrip())
        print("```\n")
    print("## date_filter (F4)\n\nYear 1996: the fact scan carries the YYYYMMDD bounds as pushed filters.\n\n```")
    print(date_filter(star, year=1996)._jdf.queryExecution().executedPlan().toString().rstrip())
    print("```\n")
    from starbeam.operators.audit import audit_foreign_keys

    print("## audit_foreign_keys (D3)\n\nAll six fact keys in two passes: distinct (key, value) pairs against the "
          "dimension keys, then a semi join on the orphan values.\n\n```")
    print(audit_foreign_keys({k: v for k, v in star.tables().items() if k != "dim_product_recommendations"})
          ._jdf.queryExecution().executedPlan().toString().rstrip())
    print("```")


if __name__ == "__main__":
    main()
