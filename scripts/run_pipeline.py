"""Run the batch pipeline: raw CSV -> Bronze -> Silver -> Gold -> (database) -> model.

    spark-submit scripts/run_pipeline.py --source DIR --root DIR [--jdbc-url URL ...]
    python scripts/run_pipeline.py --from-testdata /root/testdata/sf0.001 --root LAKE_DIR

``--root`` is the lake folder (shared storage on a cluster). ``--from-testdata`` first writes the
raw CSV files derived from the test tables into ``<root>/landing`` and uses them as source.
Prints the row count of every written table.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--source", help="folder with the raw CSV files of the manifest")
    ap.add_argument("--from-testdata", help="derive the raw CSV files from this test-table folder")
    ap.add_argument("--manifest", help="JSON file: table name -> file name in the source folder")
    ap.add_argument("--root", required=True, help="lake folder for all layers, models and metrics")
    ap.add_argument("--stamp", help="run stamp YYYYmmdd_HHMMSS (default: now)")
    ap.add_argument("--resume", action="store_true", help="go on with the run of --stamp, else with the latest unfinished one")
    ap.add_argument("--jdbc-url", help="database to load the Gold tables into (optional)")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password")
    ap.add_argument("--csv-export", help="also export the Gold tables as CSV to this folder")
    ap.add_argument("--no-train", action="store_true")
    ap.add_argument("--model", default="forest", choices=["forest", "logistic"])
    ap.add_argument("--ui", action="store_true", help="start the Spark web UI (off by default)")
    args = ap.parse_args(argv)
    if not args.source and not args.from_testdata:
        ap.error("give --source or --from-testdata")

    from pyspark.sql import SparkSession

    from delivery_lake.plans.pipeline import run_pipeline
    from delivery_lake.schemas import MANIFEST
    from delivery_lake.session import checkpoint_root
    from delivery_lake.sources import files, testdata

    existing = SparkSession.getActiveSession()
    spark = existing or (SparkSession.builder.appName("delivery_lake_pipeline")
                         .config("spark.ui.enabled", "true" if args.ui else "false").getOrCreate())
    checkpoint_root(spark)  # the session's shared checkpoint folder; a local one only if unset
    manifest = MANIFEST
    if args.manifest:
        with open(args.manifest, encoding="utf-8") as f:
            manifest = json.load(f)
    source = args.source
    if args.from_testdata:
        tables = testdata.source_tables(spark, args.from_testdata)
        source = files.write_landing(tables, f"{args.root.rstrip('/')}/landing")
        manifest = {t: MANIFEST[t] for t in tables}
    props = {k: v for k, v in (("user", args.jdbc_user), ("password", args.jdbc_password)) if v}
    summary, info = run_pipeline(spark, source, args.root, manifest, stamp=args.stamp, jdbc_url=args.jdbc_url,
                                 jdbc_properties=props, train=not args.no_train, model=args.model,
                                 csv_export_dir=args.csv_export, resume=args.resume)
    for r in summary.orderBy("layer", "table_name").collect():  # one row per written table
        print(f"{r.layer:7s} {r.table_name:28s} {r.rows:>12,}")
    print(json.dumps({k: v for k, v in info.items() if k != "csv"}, default=str))
    if existing is None:  # stop only a session this script started
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
