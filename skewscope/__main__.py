"""Command line: run the whole imbalance study over batch files.

    python -m skewscope --input 'batches/batch_*.csv.gz' --out outputs \
        --id-col SMILES --score-col SA_score --group-col scaffold
"""

from __future__ import annotations

import argparse

from skewscope.plans.study import run_from_batches
from skewscope.session import local_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="skewscope")
    ap.add_argument("--input", required=True, help="file glob or folder of batches")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--id-col", default="SMILES")
    ap.add_argument("--score-col", default="SA_score")
    ap.add_argument("--group-col", default=None)
    ap.add_argument("--quantile", default="approx", choices=["approx", "disc", "cont"])
    ap.add_argument("--p", type=float, default=0.8)
    ap.add_argument("--cap", type=int, default=500_000, help="0 keeps every training row")
    ap.add_argument("--bins", type=int, default=10)
    ap.add_argument("--scaling-sizes", default="100000,500000,1000000")
    ap.add_argument("--infer-schema", action="store_true")
    ap.add_argument("--schema", default=None, help="DDL of the batches (default: typed by their header)")
    ap.add_argument("--min-columns", type=int, default=128)
    ap.add_argument("--width", type=int, default=2048, help="bit-string width")
    ap.add_argument("--parallelism", type=int, default=1)
    ap.add_argument("--ledger", default=None, help="folder of staged batches: only new or changed files are read")
    ap.add_argument("--models", default=None, help="folder of finished fits: a run started again fits only what is missing")
    ap.add_argument("--publish", action="store_true", help="make the artefacts visible all at once, with a manifest")
    ap.add_argument("--local", action="store_true", help="start a local session (otherwise use spark-submit's)")
    args = ap.parse_args(argv)

    if args.local:
        spark = local_session()
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.getOrCreate()
    sizes = [int(x) for x in args.scaling_sizes.split(",") if x]
    run_from_batches(spark, args.input, args.out, id_col=args.id_col, score_col=args.score_col,
                     group_col=args.group_col, p=args.p, quantile=args.quantile, cap=args.cap or None,
                     bins=args.bins, scaling_sizes=sizes, fmt=args.format, infer_schema=args.infer_schema, schema=args.schema,
                     min_columns=args.min_columns, width=args.width, parallelism=args.parallelism, ledger_dir=args.ledger,
                     models_dir=args.models, publish_set=args.publish)


if __name__ == "__main__":
    main()
