"""Command line: ``python -m stockrisk --raw PATH --seed PATH [--root DIR]``.

Runs the bronze/silver jobs, builds and publishes the models and the report,
and prints the failing data-quality checks. ``--raw`` is a header CSV of raw
snapshots or, with ``--raw-table``, a catalog table name.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stockrisk.operators.quality import SUITE
from stockrisk.plans.pipeline import Lake, run_all
from stockrisk.sources.readers import read_product_master, read_raw


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stockrisk")
    ap.add_argument("--raw", required=True, help="raw snapshot CSV path, or a table name with --raw-table")
    ap.add_argument("--raw-table", action="store_true")
    ap.add_argument("--seed", required=True, help="product master CSV path")
    ap.add_argument("--root", default=None, help="folder for all published tables; by default the catalog manages them")
    ap.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("stockrisk").getOrCreate()
    raw = read_raw(spark, table=args.raw) if args.raw_table else read_raw(spark, path=args.raw)
    res = run_all(spark, raw, read_product_master(spark, args.seed), Lake(root=args.root, fmt=args.format))
    print("layer rows:", res.pipeline.counts)
    failing = res.quality.where(F.col("failures") > 0).collect()
    for r in failing:
        print(f"FAIL {r.check_name} {r.model}.{r.column_name}: {r.failures}")
    print(f"{len(SUITE) - len(failing)} of {len(SUITE)} checks pass")
    return 1 if failing else 0


if __name__ == "__main__":
    raise SystemExit(main())
