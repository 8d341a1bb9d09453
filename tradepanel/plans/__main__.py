"""spark-submit entry: ``exports``, ``gdp`` or ``training``."""

from __future__ import annotations

import argparse
import json
from datetime import datetime

from pyspark.sql import SparkSession

from ..constants import ENOUGH_RECORDS_PER_YEAR
from . import exports, gdp, training


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["exports", "gdp", "training"])
    parser.add_argument("warehouse")
    parser.add_argument("--landing")
    parser.add_argument("--all-years", action="store_true", help="gdp: also years before the first full one")
    parser.add_argument("--grid", type=json.loads, help="training: settings to tune, as JSON lists by name")
    parser.add_argument("--run-at", type=datetime.fromisoformat, required=True)
    args = parser.parse_args()
    builder = SparkSession.builder.appName(f"tradepanel-{args.job}")
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.job == "training":
        print(training.run(spark, args.warehouse, args.run_at, grid=args.grid))
    elif args.job == "exports":
        exports.run(spark, args.landing, args.warehouse, args.run_at).show(truncate=False)
    else:
        enough = None if args.all_years else ENOUGH_RECORDS_PER_YEAR
        gdp.run(spark, args.landing, args.warehouse, args.run_at, enough).show(truncate=False)


if __name__ == "__main__":
    main()
