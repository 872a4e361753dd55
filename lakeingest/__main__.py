"""Launcher: one engine run from config files.

    spark-submit --py-files lakeingest.zip lakeingest/__main__.py --engine configs/engine.json \
        --datasets configs/datasets [--only shop.orders,shop.readings] [--run-id ID]
    python -m lakeingest ...          (local session)

Every dataset file is validated before anything starts; ``--only`` then keeps
the listed datasets (comma separated, blanks ignored; empty = all enabled).
Prints the run report and exits with status 1 when a dataset failed.
"""

from __future__ import annotations

import argparse
import logging
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lakeingest", description=__doc__.splitlines()[0])
    parser.add_argument("--engine", required=True, help="engine JSON file")
    parser.add_argument("--datasets", required=True, help="directory of dataset JSON files")
    parser.add_argument("--only", default="", help="comma-separated datasource.dataset names")
    parser.add_argument("--run-id", default=None)
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    from pyspark.sql import SparkSession

    from lakeingest.spec import EngineSpec, load_dataset_specs
    from lakeingest.streaming.audit import results_frame, run_report
    from lakeingest.streaming.runner import run_ingestion

    only = [n.strip() for n in args.only.split(",") if n.strip()]
    engine = EngineSpec.load(args.engine)
    specs = load_dataset_specs(args.datasets, only=only or None)
    spark = SparkSession.builder.appName("lakeingest").getOrCreate()
    results = run_ingestion(spark, engine, specs, run_id=args.run_id)
    if results:
        run_report(results_frame(spark, results)).show(len(results), truncate=False)
    return 1 if any(r.status == "ERROR" for r in results) else 0


if __name__ == "__main__":
    sys.exit(main())
