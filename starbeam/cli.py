"""Command line for the warehouse.

    python -m starbeam.cli load --csv DIR --star ROOT              CSV order files -> star (full or incremental)
    python -m starbeam.cli recommend --report DIR --pairs FILE --star ROOT [--date YYYY-MM-DD]
    python -m starbeam.cli query NAME --star ROOT [--rows N]        a golden query, chart or report by key
    python -m starbeam.cli sql "SELECT ..." --star ROOT [--rows N]  Spark SQL over the star's tables
    python -m starbeam.cli list                                      the query keys

Without a cluster it runs on ``local[*]``; on a cluster use ``spark-submit``
with the same arguments (the session's ``spark.checkpoint.dir`` is used).
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .plans import golden as GQ
from .plans import reports as AR
from .plans.metrics import CHARTS
from .plans.star import Star, vds_discount, vds_main, vds_recommendations

STAR_QUERIES = {**GQ.GOLDEN, **CHARTS, **AR.REPORTS, "break_even_products": AR.break_even_products,
                "vds_main": vds_main, "vds_discount": vds_discount, "vds_recommendations": vds_recommendations}


def register_views(star: Star, spark: SparkSession | None = None) -> list[str]:
    """Expose the star's tables (and the three wide views) as SQL temp views."""
    names = []
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)
        names.append(name)
    vds_main(star).createOrReplaceTempView("vds_main")
    vds_discount(star).createOrReplaceTempView("vds_discount")
    names += ["vds_main", "vds_discount"]
    if star.dim_product_recommendations is not None:
        vds_recommendations(star).createOrReplaceTempView("vds_recommendations")
        names.append("vds_recommendations")
    return names


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import local_session

    return local_session()


def _show(df: DataFrame, rows: int) -> None:
    df.show(rows, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="starbeam")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("load")
    a.add_argument("--csv", required=True)
    a.add_argument("--max-surplus", type=int, default=0, help="rows with surplus fields that a load may hold")
    a.add_argument("--star", required=True)
    a = sub.add_parser("recommend")
    a.add_argument("--report", required=True)
    a.add_argument("--pairs", required=True)
    a.add_argument("--star", required=True)
    a.add_argument("--date", default=None)
    a = sub.add_parser("query")
    a.add_argument("name")
    a.add_argument("--star", required=True)
    a.add_argument("--rows", type=int, default=50)
    a = sub.add_parser("sql")
    a.add_argument("statement")
    a.add_argument("--star", required=True)
    a.add_argument("--rows", type=int, default=50)
    sub.add_parser("list")
    args = p.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(sorted(STAR_QUERIES)))
        return 0
    spark = _session()
    from .sources.star_store import publish_increment, publish_recommendations, publish_star, published, read_star

    if args.cmd == "load":
        from .operators.clean import clean_orders_observed
        from .plans.star import build_star, increment
        from .session import scratch, written
        from .sources.csv import read_orders_csv

        # the clean record is written once; the reject counts arrive with that job
        with scratch(spark):
            raw = read_orders_csv(spark, args.csv, args.max_surplus)
            clean, raw_obs, kept_obs = clean_orders_observed(raw)
            with written(clean, "clean") as rows:
                print({**raw_obs.get, **kept_obs.get})
                if published(spark, args.star) is None:
                    print(publish_star(build_star(rows), args.star))
                else:
                    star = read_star(spark, args.star)
                    dims, new_facts = increment(star, rows)
                    print(publish_increment(star.with_(**dims), new_facts, args.star))
        return 0
    star = read_star(spark, args.star)
    if args.cmd == "recommend":
        from .plans.recs import load_recommendations
        from .sources.csv import read_recommendations
        from .sources.report import read_report_lines

        day = _dt.date.fromisoformat(args.date) if args.date else _dt.date.today()
        new = load_recommendations(spark, star, read_report_lines(spark, args.report),
                                   read_recommendations(spark, args.pairs), day)
        print(publish_recommendations(new, args.star))
        return 0
    if args.cmd == "query":
        _show(STAR_QUERIES[args.name](star), args.rows)
        return 0
    if args.cmd == "sql":
        register_views(star, spark)
        _show(spark.sql(args.statement), args.rows)
        return 0
    return 1


if __name__ == "__main__":
    raise SystemExit(main())
