"""Composite pipelines Q1-Q7: functions of DataFrames, with paths only at the edges.

Each ``*_pipeline`` reads its inputs, runs the operators lazily and performs one
write (or returns small results).  The ``monitoring`` and ``evaluation`` cores
take DataFrames so they can run on tables that never touch a file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..constants import FEATURE_COLUMNS, LABEL_COLUMN, SPLIT_SEED, SPLIT_WEIGHTS
from ..operators import aggregates as agg
from ..operators import evaluation as ev
from ..operators import features as feat
from ..operators import learning as ml
from ..operators import prepare as prep
from ..operators import sampling
from ..session import drop_scratch, materialize, scratch_path
from ..sources import io

SCORED_CASTS = {"prob_0": "double", "prob_1": "double", "prediction": "double"}
LABEL_CASTS = {"is_fraud": "double"}


def feature_pipeline(spark: SparkSession, input_path: str, output_path: str,
                     fmt: str = "parquet", schema=io.TRANSACTION_SCHEMA,
                     stage_input: bool = True) -> str:
    """Q1: raw CSV -> preprocess -> W1..W4, D1 -> feature table.

    The feature plan reads its input three times (per-second answers, category
    counts, the rows themselves).  With ``stage_input`` the parsed rows are first
    written once as parquet in the shared checkpoint folder, so the text is parsed
    once and the three reads are pruned columnar scans; the copy is removed at the end.
    """
    raw = prep.preprocess(io.read_transactions(spark, input_path, schema))
    if stage_input:
        staged = scratch_path(spark, "parsed-transactions")
        raw.write.parquet(staged)
        raw = spark.read.parquet(staged)
    features = feat.full_feature_engineering(raw)
    io.write_features(features, output_path, fmt)
    if stage_input:
        drop_scratch(spark, staged)
    return output_path


def split_pipeline(spark: SparkSession, input_path: str, train_path: str,
                   inference_path: str, weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED,
                   stable_key: str | None = None,
                   schema=io.TRANSACTION_SCHEMA) -> tuple[str, str]:
    """Q2: raw CSV -> two CSVs.  ``stable_key=None`` is the reference's random split;
    a key column gives the layout-independent hash split (X2) of two sides.  Weights
    are normalised by their sum."""
    raw = io.read_transactions(spark, input_path, schema)
    if stable_key is None:
        train, inference = sampling.random_split(raw, weights, seed)
    else:
        train, inference = sampling.stable_split(raw, stable_key, split_percent(weights), seed)
    io.write_csv(train, train_path)
    io.write_csv(inference, inference_path)
    return train_path, inference_path


def split_percent(weights) -> float:
    """The first side's share of two weights, in percent."""
    if len(weights) != 2 or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError(f"a stable split takes two weights, not {tuple(weights)}")
    return 100 * weights[0] / sum(weights)


@dataclass
class TrainingResult:
    cv: ml.CVResult
    auc: float
    model_path: str | None


def training_frame(features: DataFrame, feature_columns=FEATURE_COLUMNS,
                   label_col: str = LABEL_COLUMN) -> DataFrame:
    """L1 + A2: assembled, int-labelled, class-weighted training rows."""
    return agg.add_class_weight(ml.prepare_training(features, feature_columns, label_col),
                                label_col)


def training_pipeline(spark: SparkSession, features_path: str, model_path: str | None,
                      fmt: str = "parquet", feature_columns=FEATURE_COLUMNS, **cv_kw) -> TrainingResult:
    """Q3: feature table -> L1 -> A2 -> L3 -> L5 -> saved model."""
    data = training_frame(io.read_features(spark, features_path, fmt), feature_columns)
    cv = ml.train_with_cv(data, **cv_kw)
    auc = ml.auc_model(cv.model, data)
    if model_path:
        io.save_model(cv.model, model_path)
    return TrainingResult(cv, auc, model_path)


def scoring_pipeline(spark: SparkSession, features_path: str, model_path: str,
                     output_path: str, fmt: str = "parquet",
                     feature_columns=FEATURE_COLUMNS) -> str:
    """Q4: feature table + saved model -> P9 -> L4 -> P7 -> scored CSV."""
    model = io.load_model(model_path)
    data = prep.assemble_features(io.read_features(spark, features_path, fmt), feature_columns)
    io.write_csv(ml.score(model, data), output_path)
    return output_path


def label_pipeline(spark: SparkSession, features_path: str, output_path: str,
                   fmt: str = "parquet", label_col: str = LABEL_COLUMN) -> str:
    """Q5: feature table -> P4 -> (transaction_id, is_fraud) CSV."""
    truth = prep.label_to_double(io.read_features(spark, features_path, fmt), label_col)
    io.write_csv(truth.select("transaction_id", label_col), output_path)
    return output_path


def _outcomes(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """J1, then the written counts that the statistics of Q6 and Q7 read."""
    return materialize(ev.outcome_counts(ev.join_truth(
        scored.select("transaction_id", "prob_1", "prediction"), labels)))


def monitoring(scored: DataFrame, labels: DataFrame,
               auc_method: str = "exact") -> tuple[DataFrame, DataFrame]:
    """Q6 core: J1 -> L6 and A5 (prediction distribution).

    ``auc_method="exact"`` is the un-binned area; ``"binned"`` is MLlib's evaluator
    with its default 1,000-bin ROC, as the reference's monitoring step computes it.
    The rows are joined and aggregated once: both results read the written counts by
    (score, label, prediction)."""
    seen = _outcomes(scored, labels)
    if auc_method == "exact":
        auc = ev.auc_exact(seen, count_col="n")
    elif auc_method == "binned":
        auc = seen.sparkSession.createDataFrame([(ev.auc_binned(seen, count_col="n"),)], "auc double")
    else:
        raise ValueError(f"unknown auc_method {auc_method!r}")
    return auc, agg.prediction_distribution(seen, count_col="n")


def monitoring_pipeline(spark: SparkSession, scored_path: str, labels_path: str,
                        auc_method: str = "exact") -> tuple[DataFrame, DataFrame]:
    """Q6: scored CSV + label CSV -> (auc row, prediction counts)."""
    scored = io.read_with_casts(spark, scored_path, SCORED_CASTS)
    labels = io.read_with_casts(spark, labels_path, LABEL_CASTS)
    return monitoring(scored, labels, auc_method)


@dataclass
class EvaluationResult:
    metrics: DataFrame      # tp fp tn fn accuracy precision recall f1_score
    histogram: DataFrame    # bin lower upper count


def evaluation(scored: DataFrame, labels: DataFrame) -> EvaluationResult:
    """Q7 core: J1 -> A6 -> A7, and A8 over the joined probabilities.

    The rows are joined and aggregated once: the metrics and the histogram read the written
    counts by (score, label, prediction)."""
    seen = _outcomes(scored, labels)
    return EvaluationResult(ev.evaluate_predictions(seen, count_col="n"),
                            agg.probability_histogram(seen, "prob_1", count_col="n"))


def evaluation_pipeline(spark: SparkSession, scored_path: str,
                        labels_path: str) -> EvaluationResult:
    """Q7: scored CSV + label CSV -> metrics row and histogram."""
    scored = io.read_with_casts(spark, scored_path, SCORED_CASTS)
    labels = io.read_with_casts(spark, labels_path, LABEL_CASTS)
    return evaluation(scored, labels)

