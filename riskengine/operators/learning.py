"""Learning and scoring with MLlib (distributed: every fit iteration is a tree aggregate).

L1 ``prepare_training``, L2 ``fit_logistic``, L3 ``train_with_cv``, L4 ``score``,
L5 ``auc_model``.  Unlike the reference, the cross-validation seed is fixed
(its default changes per Python process) and all grid points and folds are fitted, to
convergence, from shared passes over the training rows (:mod:`.newton`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ..constants import (CV_PARALLELISM, CV_SEED, FEATURE_COLUMNS, LABEL_COLUMN, MAX_ITER,
                         NUM_FOLDS, REG_PARAMS, WEIGHT_COLUMN)
from . import newton
from .evaluation import auc_exact
from .prepare import assemble_features, flatten_probability, label_to_int


def prepare_training(df: DataFrame, feature_columns: Sequence[str] = FEATURE_COLUMNS,
                     label_col: str = LABEL_COLUMN) -> DataFrame:
    """L1: assemble ``features`` and make the label an int."""
    return label_to_int(assemble_features(df, feature_columns), label_col)


def logistic(label_col: str = LABEL_COLUMN, weight_col: str | None = WEIGHT_COLUMN,
             max_iter: int = MAX_ITER, reg_param: float = 0.0, tol: float = 1e-6) -> LogisticRegression:
    """The reference's estimator: weighted, L2 (elasticNet 0), threshold 0.5, standardised."""
    kw = {"weightCol": weight_col} if weight_col else {}
    return LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter,
                              regParam=reg_param, tol=tol, **kw)


def fit_logistic(df: DataFrame, label_col: str = LABEL_COLUMN,
                 weight_col: str | None = WEIGHT_COLUMN, max_iter: int = MAX_ITER,
                 reg_param: float = 0.0, tol: float = 1e-6) -> LogisticRegressionModel:
    """L2: one weighted logistic-regression fit."""
    return logistic(label_col, weight_col, max_iter, reg_param, tol).fit(df)


@dataclass
class CVResult:
    model: LogisticRegressionModel
    reg_params: list[float]
    avg_auc: list[float]
    best_reg_param: float
    fits: list[newton.Fit] = field(default_factory=list)   # of method "shared", by penalty, then fold

    def metrics(self, spark) -> DataFrame:
        """Grid results as a table: ``reg_param, avg_auc, is_best``."""
        rows = [(float(r), float(a), bool(r == self.best_reg_param))
                for r, a in zip(self.reg_params, self.avg_auc)]
        return spark.createDataFrame(rows, "reg_param double, avg_auc double, is_best boolean")


def hashed_fold(df: DataFrame, num_folds: int, seed: int) -> Column:
    """A fold from a row's values: the same whatever the layout, also when a lost task is rerun."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(num_folds))


def _cv_shared(df: DataFrame, label_col: str, weight_col: str | None, reg_params: Sequence[float],
               num_folds: int, seed: int, fold_col: str | None) -> tuple[list[float], list[newton.Fit]]:
    """Mean AUC of every penalty, and the fits: all of them from the same passes."""
    fold = F.col(fold_col) if fold_col else hashed_fold(df, num_folds, seed)
    d = newton.width(df)
    rows = newton.narrow(df, label_col, weight_col, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = newton.fit_grid(rows, [(k, reg) for reg in reg_params for k in range(num_folds)], d)
        auc = {r["fit"]: r["auc"] for r in auc_exact(newton.margins(rows, fits, d), "y", "margin", by=["fit"]).collect()}
    finally:
        rows.unpersist()
    each = [auc.get(i) for i in range(len(fits))]
    each = [math.nan if a is None else a for a in each]  # a fold without both classes has none
    return [sum(each[i:i + num_folds]) / num_folds for i in range(0, len(each), num_folds)], fits


def train_with_cv(df: DataFrame, label_col: str = LABEL_COLUMN,
                  weight_col: str | None = WEIGHT_COLUMN,
                  reg_params: Sequence[float] = REG_PARAMS, num_folds: int = NUM_FOLDS,
                  max_iter: int = MAX_ITER, seed: int = CV_SEED,
                  parallelism: int = CV_PARALLELISM, fold_col: str | None = None,
                  method: str = "shared") -> CVResult:
    """L3: grid over ``regParam``, k-fold CV on area under ROC, refit the best on all rows.

    Folds come from a hash of the row's values and ``seed``, or from ``fold_col`` (integers from
    0 to ``num_folds - 1``); either way they are independent of the data's layout.

    ``method="shared"`` fits all ``len(grid) * folds`` models to convergence, a pass over the
    persisted rows for each Newton step of all of them, and takes their exact areas in one more
    (:mod:`.newton`; up to ``newton.MAX_FEATURES`` features).  ``"mllib"`` is MLlib's
    ``CrossValidator``: ``max_iter`` iterations a fit, ``parallelism`` of them at once, areas of
    1,000 bins.  The model returned is MLlib's fit of the best penalty, with ``max_iter``, in both.
    """
    reg_params = list(reg_params)
    if method == "shared":
        avg, fits = _cv_shared(df, label_col, weight_col, reg_params, num_folds, seed, fold_col)
        best = max(range(len(avg)), key=lambda i: (not math.isnan(avg[i]), avg[i]))
        model = fit_logistic(df, label_col, weight_col, max_iter, reg_params[best])
        return CVResult(model, reg_params, avg, float(reg_params[best]), fits)
    if method != "mllib":
        raise ValueError(f"unknown method {method!r}")
    lr = logistic(label_col, weight_col, max_iter)
    grid = ParamGridBuilder().addGrid(lr.regParam, reg_params).build()
    evaluator = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderROC")
    if not fold_col:
        fold_col, df = "_cv_fold", df.withColumn("_cv_fold", hashed_fold(df, num_folds, seed).cast("int"))
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=evaluator,
                        numFolds=num_folds, seed=seed, parallelism=parallelism, foldCol=fold_col)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cached.count()  # fill the cache once, before fits run side by side
        cv_model = cv.fit(cached)
    finally:
        cached.unpersist()
    avg = list(cv_model.avgMetrics)
    best = max(range(len(avg)), key=lambda i: avg[i])
    return CVResult(cv_model.bestModel, reg_params, avg, float(reg_params[best]))


def fit_certificate(df: DataFrame, model: LogisticRegressionModel, reg_param: float, label_col: str = LABEL_COLUMN,
                    weight_col: str | None = WEIGHT_COLUMN) -> dict:
    """L2's check: loss, largest gradient and remaining gap of a fitted model on its rows (:func:`.newton.certificate`)."""
    d = len(model.coefficients)
    return newton.certificate(newton.narrow(df, label_col, weight_col), model.coefficients.toArray(), model.intercept, reg_param, d)


def score(model, df: DataFrame, keep: Sequence[str] = ("transaction_id", "customer_id"),
          flatten: bool = True) -> DataFrame:
    """L4 (+ P7): ``model.transform``, then ``keep`` columns with ``prob_0, prob_1, prediction``.

    With ``flatten=False`` the vectors stay (``features, probability``), as in the
    reference's in-memory predictions.
    """
    out = model.transform(df)
    if not flatten:
        return out.select(*keep, "features", "probability", "prediction")
    return flatten_probability(out).select(*keep, "prob_0", "prob_1", "prediction")


def auc_model(model, df: DataFrame, label_col: str = LABEL_COLUMN) -> float:
    """Area under ROC of ``model`` on ``df`` (MLlib evaluator on ``rawPrediction``)."""
    evaluator = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderROC")
    return evaluator.evaluate(model.transform(df))
