"""Command line: list and run registered queries, or run the full refresh.

    python -m pricelens list
    python -m pricelens query weekly_summary --sf-dir /root/testdata/sf0.01 --show 20
    python -m pricelens refresh --sf-dir /root/testdata/sf0.01 [--pages DIR] [--zones PATH]
                                [--catalog NAME] [--model additive|linear_seasonal]
                                [--as-of YYYY-MM-DD]

The master and other settings come from spark-submit / the environment; with
none given a local session is used.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pricelens.config import DEFAULT


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="pricelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--explain", action="store_true")
    r = sub.add_parser("refresh", help="write bronze, silver, gold tables and the margin view")
    r.add_argument("--sf-dir", required=True, help="driver tables (records and zones source)")
    r.add_argument("--pages", help="landed page files to load instead of derived records")
    r.add_argument("--zones", help="parquet path of delivery zones (default: derived)")
    r.add_argument("--catalog", default="")
    r.add_argument("--model", default="additive", choices=["additive", "linear_seasonal"])
    r.add_argument("--as-of")
    args = ap.parse_args(argv)

    from pricelens.plans.registry import all_queries
    if args.cmd == "list":
        print("\n".join(sorted(all_queries())))
        return 0

    from pyspark.sql import SparkSession

    from pricelens.session import BASE_CONF
    builder = SparkSession.builder.appName("pricelens")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()

    if args.cmd == "query":
        df = all_queries()[args.name](spark, args.sf_dir)
        if args.explain:
            df.explain("formatted")
        df.show(args.show, truncate=False)
        return 0

    from pricelens.plans.refresh import RefreshInputs, refresh_all
    from pricelens.sources import adapter
    cfg = replace(DEFAULT, catalog=args.catalog)
    zones = (spark.read.parquet(args.zones) if args.zones
             else adapter.delivery_zones(spark, args.sf_dir))
    inputs = RefreshInputs(zones=zones, pages_path=args.pages,
                           records=None if args.pages else adapter.price_records(
                               spark, args.sf_dir, cfg.ingest_products))
    counts = refresh_all(spark, inputs, cfg, as_of=args.as_of, model=args.model)
    print(json.dumps(counts))
    return 0


if __name__ == "__main__":
    sys.exit(main())
