"""Evaluation: join with the truth, confusion counts, metrics, exact AUC, top-k risk.

All results are DataFrames (one row for the global metrics), so they can be
written, joined or collected by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..constants import LABEL_COLUMN, PREDICTION_COLUMN, SCORE_COLUMN
from ..session import materialize


def join_truth(scored: DataFrame, labels: DataFrame, on: str = "transaction_id",
               how: str = "inner") -> DataFrame:
    """Equi-join scores with labels (``USING`` form: one key column).

    Duplicate ids multiply rows, as in any equi-join.  Spark picks broadcast or
    sort-merge from the sizes; AQE re-plans at run time.
    """
    return scored.join(labels, on=on, how=how)


def outcome_counts(df: DataFrame, label_col: str = LABEL_COLUMN, score_col: str = SCORE_COLUMN,
                   prediction_col: str = PREDICTION_COLUMN, out: str = "n") -> DataFrame:
    """Rows by (score, label, prediction): all that A5-A8 and L6 need to know of the joined rows.

    A grouped count with map-side partial aggregation.  Written once, it lets every statistic be
    taken (with ``count_col``) from one pass over the rows; it is never longer than they are.
    """
    return df.groupBy(score_col, label_col, prediction_col).agg(F.count(F.lit(1)).alias(out))


def rows_where(cond: Column, count_col: str | None) -> Column:
    """Rows that meet a condition; with ``count_col`` a row stands for so many."""
    if count_col is None:
        return F.count_if(cond)
    return F.coalesce(F.sum(F.when(cond, F.col(count_col))), F.lit(0))


def confusion_matrix(df: DataFrame, prediction_col: str = PREDICTION_COLUMN,
                     label_col: str = LABEL_COLUMN, count_col: str | None = None) -> DataFrame:
    """One row ``tp, fp, tn, fn``.  A null prediction or label counts in none."""
    p, y = F.col(prediction_col), F.col(label_col)
    one, zero = F.lit(1.0), F.lit(0.0)
    return df.agg(rows_where((p == one) & (y == one), count_col).alias("tp"),
                  rows_where((p == one) & (y == zero), count_col).alias("fp"),
                  rows_where((p == zero) & (y == zero), count_col).alias("tn"),
                  rows_where((p == zero) & (y == one), count_col).alias("fn"))


def classification_metrics(cm: DataFrame) -> DataFrame:
    """Add ``accuracy, precision, recall, f1_score`` to a confusion-matrix row.

    Precision, recall and F1 fall to 0.0 on a zero denominator; accuracy is null
    when there are no rows at all.
    """
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    total = tp + tn + fp + fn
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    with_pr = cm.withColumns({
        "accuracy": F.when(total > 0, (tp + tn) / total),
        "precision": precision,
        "recall": recall,
    })
    p, r = F.col("precision"), F.col("recall")
    return with_pr.withColumn(
        "f1_score", F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0)))


def evaluate_predictions(df: DataFrame, prediction_col: str = PREDICTION_COLUMN,
                         label_col: str = LABEL_COLUMN, count_col: str | None = None) -> DataFrame:
    """A6 + A7 in one job."""
    return classification_metrics(confusion_matrix(df, prediction_col, label_col, count_col))


def score_label_counts(df: DataFrame, label_col: str = LABEL_COLUMN,
                       score_col: str = SCORE_COLUMN, by: Sequence[str] = (),
                       count_col: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score (rows with a null or NaN score, or a
    label other than 0/1, are left out, as the evaluator cannot use them)."""
    y, s = F.col(label_col).try_cast("double"), F.col(score_col).try_cast("double")
    return (df.where(s.isNotNull() & ~F.isnan(s) & y.isin(0.0, 1.0))
            .groupBy(*by, s.alias("score"))
            .agg(rows_where(y == F.lit(1.0), count_col).alias("pos"),
                 rows_where(y == F.lit(0.0), count_col).alias("neg")))


def auc_exact(df: DataFrame, label_col: str = LABEL_COLUMN, score_col: str = SCORE_COLUMN,
              partitions: int | None = None, by: Sequence[str] = (),
              count_col: str | None = None) -> DataFrame:
    """Exact area under the ROC curve, one row ``auc`` (null if a class is absent).

    ``AUC = sum_s pos(s) * (neg_below(s) + neg(s) / 2) / (P * N)`` over distinct
    scores ``s`` -- the Mann-Whitney form, ties counted half; it equals the
    trapezoid area of the un-binned ROC curve.  With ``by``, a row for each group of those
    columns, all from the same pass.

    The running count ``neg_below`` needs the scores in order, but never in one task:
    distinct scores (ties have collapsed, so none is hot) are range-partitioned into
    ``partitions`` ordered parts (the session's shuffle partitions by default) and written
    once; a running sum over one row a part gives each part's offset, and a window inside
    each part the rest.  Sums are exact decimals, so the answer does not depend on
    partitioning.
    """
    spark, by = df.sparkSession, list(by)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    counts = materialize(score_label_counts(df, label_col, score_col, by, count_col).repartitionByRange(parts, *by, "score")
                         .withColumn("part", F.spark_partition_id()))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.groupBy(*by, "part").agg(F.sum("neg").alias("part_neg"))
               .select(*by, "part", F.coalesce(F.sum("part_neg").over(earlier), F.lit(0)).alias("neg_before")))
    within = Window.partitionBy(*by, "part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (counts.join(offsets, [*by, "part"])
              .withColumn("neg_below", F.col("neg_before") + F.coalesce(F.sum("neg").over(within), F.lit(0))))

    big = DecimalType(38, 0)
    term = (F.col("pos").cast(big)
            * (F.lit(2) * F.col("neg_below") + F.col("neg")).cast(big))
    totals = ranked.groupBy(*by).agg(F.sum(term).alias("num2"), F.sum("pos").alias("p"),
                                     F.sum("neg").alias("n"))
    p, n = F.col("p"), F.col("n")
    return totals.select(
        *by, F.when((p > 0) & (n > 0),
                    F.col("num2").cast("double") / (F.lit(2.0) * p.cast("double") * n.cast("double")))
        .alias("auc"))


def auc_binned(df: DataFrame, label_col: str = LABEL_COLUMN, score_col: str = SCORE_COLUMN,
               num_bins: int = 1000, count_col: str | None = None) -> float:
    """L6 as the reference computes it: MLlib's evaluator (ROC down-sampled to ``num_bins``;
    ``num_bins=0`` gives the exact curve).  ``count_col`` becomes the evaluator's weight."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    weight = {"weightCol": "_rows"} if count_col else {}
    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol=score_col,
                                       metricName="areaUnderROC", numBins=num_bins, **weight)
    rows = F.col(count_col).cast("double") if count_col else F.lit(1.0)
    return ev.evaluate(df.select(F.col(label_col).cast("double").alias(label_col),
                                 F.col(score_col).cast("double").alias(score_col), rows.alias("_rows")))


def top_risk(scored: DataFrame, k: int = 100, score_col: str = SCORE_COLUMN,
             tie_col: str = "transaction_id") -> DataFrame:
    """O1: the ``k`` highest-risk rows, ties broken by ``tie_col`` (a top-k per task,
    then one merge of ``k`` rows per task -- no full sort)."""
    return scored.orderBy(F.col(score_col).desc_nulls_last(), F.col(tie_col).asc()).limit(k)
