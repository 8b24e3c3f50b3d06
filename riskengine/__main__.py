"""Command line: the seven pipelines, in the order the reference runs them.

    python -m riskengine split    RAW.csv TRAIN.csv INFERENCE.csv [--stable-key transaction_id]
    python -m riskengine features TRAIN.csv TRAIN_FEATURES [--raw-layout]
    python -m riskengine train    TRAIN_FEATURES MODEL
    python -m riskengine score    INFERENCE_FEATURES MODEL SCORED.csv
    python -m riskengine labels   INFERENCE_FEATURES LABELS.csv
    python -m riskengine monitor  SCORED.csv LABELS.csv [--binned-auc]
    python -m riskengine evaluate SCORED.csv LABELS.csv

The session comes from ``SparkSession.builder.getOrCreate()``, so a cluster's
``spark-submit`` configuration applies; ``--local N`` starts a ``local[N]``
session instead.  Small results (metrics, counts, histogram) are printed as
JSON lines.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans import pipelines as pl
from .sources import io


def _rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]          # one row, or one row per bin / class


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="riskengine", description=__doc__.split("\n\n")[0])
    ap.add_argument("--local", type=int, default=None, help="run on local[N]")
    ap.add_argument("--format", default="parquet", help="feature table format (parquet, delta)")
    sub = ap.add_subparsers(dest="step", required=True)
    s = sub.add_parser("split", help="Q2: raw CSV -> train and inference CSVs")
    s.add_argument("raw"), s.add_argument("train"), s.add_argument("inference")
    s.add_argument("--stable-key", default=None, help="hash split on this key (layout-free)")
    s.add_argument("--raw-layout", action="store_true", help="read with RAW_CSV_SCHEMA")
    s = sub.add_parser("features", help="Q1: CSV -> feature table")
    s.add_argument("input"), s.add_argument("output")
    s.add_argument("--raw-layout", action="store_true", help="read with RAW_CSV_SCHEMA")
    s = sub.add_parser("train", help="Q3: feature table -> CV -> saved model")
    s.add_argument("features"), s.add_argument("model")
    s = sub.add_parser("score", help="Q4: feature table + model -> scored CSV")
    s.add_argument("features"), s.add_argument("model"), s.add_argument("output")
    s = sub.add_parser("labels", help="Q5: feature table -> label CSV")
    s.add_argument("features"), s.add_argument("output")
    s = sub.add_parser("monitor", help="Q6: AUC and prediction counts")
    s.add_argument("scored"), s.add_argument("labels")
    s.add_argument("--binned-auc", action="store_true", help="MLlib's 1,000-bin AUC")
    s = sub.add_parser("evaluate", help="Q7: confusion, metrics, histogram")
    s.add_argument("scored"), s.add_argument("labels")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName(f"riskengine-{args.step}")
    if args.local:
        builder = builder.master(f"local[{args.local}]").config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    schema = io.RAW_CSV_SCHEMA if getattr(args, "raw_layout", False) else io.TRANSACTION_SCHEMA

    if args.step == "split":
        pl.split_pipeline(spark, args.raw, args.train, args.inference,
                          stable_key=args.stable_key, schema=schema)
    elif args.step == "features":
        pl.feature_pipeline(spark, args.input, args.output, args.format, schema=schema)
    elif args.step == "train":
        result = pl.training_pipeline(spark, args.features, args.model, args.format)
        print(json.dumps({"best_reg_param": result.cv.best_reg_param,
                          "avg_auc": dict(zip(map(str, result.cv.reg_params),
                                              map(float, result.cv.avg_auc))),
                          "auc": result.auc, "model": result.model_path}))
    elif args.step == "score":
        pl.scoring_pipeline(spark, args.features, args.model, args.output, args.format)
    elif args.step == "labels":
        pl.label_pipeline(spark, args.features, args.output, args.format)
    elif args.step == "monitor":
        auc, dist = pl.monitoring_pipeline(spark, args.scored, args.labels,
                                           "binned" if args.binned_auc else "exact")
        print(json.dumps({"auc": _rows(auc)[0]["auc"], "predictions": _rows(dist)}))
    elif args.step == "evaluate":
        result = pl.evaluation_pipeline(spark, args.scored, args.labels)
        print(json.dumps({"metrics": _rows(result.metrics)[0],
                          "histogram": _rows(result.histogram)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
