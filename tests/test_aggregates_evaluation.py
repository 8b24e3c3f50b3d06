"""Aggregates and evaluation: fixed expectations, rules 7-9 and 11,
exact AUC against brute force and MLlib, histogram against numpy."""

from __future__ import annotations

import random

import numpy as np
import pytest

from riskengine.operators import aggregates as agg
from riskengine.operators import evaluation as ev


# --- fixed values (inputs and results that must equal the reference's) ----------
FIXED_LABELS = [0, 1, 0]
FIXED_COUNTS = (50, 10, 30, 10)                       # TP, FP, TN, FN
FIXED_METRICS = {"accuracy": 0.8, "precision": 0.8333, "recall": 0.8333, "f1_score": 0.8333}
FIXED_SCORES = [(1.0, 0.9), (0.0, 0.2), (1.0, 0.8), (0.0, 0.1)]   # AUC 1


# --- class balance ------------------------------------------------------------

def test_class_weight_values_and_null_label(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "is_fraud int")
    counts = agg.class_counts(df).first()
    assert (counts["total"], counts["positive"], counts["negative"]) == (5, 1, 3)
    out = {(r[0], r[1]) for r in agg.add_class_weight(df).collect()}
    assert out == {(1, 5 / 2), (0, 5 / 6), (None, 5 / 6)}   # null takes the negative weight


def test_class_weight_is_lazy_and_fails_on_an_absent_class(spark):
    one_class = agg.add_class_weight(spark.createDataFrame([(0,), (0,)], "is_fraud int"))
    with pytest.raises(Exception, match="class absent"):
        one_class.collect()
    empty = agg.add_class_weight(spark.createDataFrame([], "is_fraud int"))
    assert empty.count() == 0 and dict(empty.dtypes)["class_weight"] == "double"


def test_class_weight_one_weight_per_class(spark):
    df = spark.createDataFrame([(x,) for x in FIXED_LABELS], "is_fraud int")
    w = agg.add_class_weight(df)
    assert w.select("class_weight").distinct().count() == 2
    assert {r[0]: r[1] for r in w.distinct().collect()} == {0: 0.75, 1: 1.5}


# --- summaries ------------------------------------------------------------------

def test_feature_distribution_single_job_values(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, None), (3.0, 30)], "feature1 double, feature2 long")
    rows = {r["feature"]: r for r in agg.feature_distribution(df, ["feature1", "feature2"]).collect()}
    assert rows["feature1"]["mean"] == 2.0 and rows["feature1"]["stddev"] == 1.0
    assert rows["feature1"]["count"] == 3
    assert rows["feature2"]["mean"] == 20.0 and rows["feature2"]["count"] == 2


def test_describe_single_row_stddev_is_null(spark):
    df = spark.createDataFrame([(5.0,)], "amount double")
    row = agg.describe(df).first()
    assert (row["column"], row["count"], row["mean"], row["stddev"], row["min"], row["max"]) == (
        "amount", 1, 5.0, None, 5.0, 5.0)


def test_describe_numeric_and_text_columns(spark):
    df = spark.createDataFrame([(1, "b", True), (3, "a", False), (None, None, None)],
                               "n int, cat string, flag boolean")
    rows = {r["column"]: r for r in agg.describe(df).collect()}
    assert set(rows) == {"n", "cat"}                          # booleans are not described
    assert (rows["n"]["count"], rows["n"]["mean"], rows["n"]["min"], rows["n"]["max"]) == (
        2, 2.0, 1.0, 3.0)
    assert (rows["cat"]["count"], rows["cat"]["min_text"], rows["cat"]["max_text"]) == (2, "a", "b")
    assert rows["cat"]["mean"] is None
    assert (rows["n"]["min_text"], rows["n"]["max_text"]) == ("1", "3")   # exact integers as text


def test_describe_keeps_integers_beyond_doubles(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(big + 1,), (big + 3,)], "id long")
    row = agg.describe(df).first()
    assert (row["min_text"], row["max_text"]) == (str(big + 1), str(big + 3))


def test_summaries_of_no_columns_are_empty(spark):
    df = spark.createDataFrame([(True,)], "flag boolean")
    assert agg.describe(df).count() == 0
    assert agg.feature_distribution(df, []).count() == 0


def test_prediction_distribution_counts_a_null_class(spark):
    df = spark.createDataFrame([(1.0,), (None,), (0.0,), (1.0,), (1.0,), (None,)], "prediction double")
    assert {r[0]: r[1] for r in agg.prediction_distribution(df).collect()} == {0.0: 1, 1.0: 3, None: 2}


@pytest.mark.parametrize("values", [
    [random.Random(1).random() for _ in range(500)],
    [round(random.Random(2).random(), 2) for _ in range(500)],      # many ties on edges
    [0.3] * 10,                                                       # all equal: bin 10
    [i / 20 for i in range(21)],                                      # values on every edge
])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "prob_1 double")
    got = sorted((r["bin"], r["lower"], r["upper"], r["count"])
                 for r in agg.probability_histogram(df).collect())
    counts, edges = np.histogram(values, bins=20)
    assert [g[3] for g in got] == counts.tolist()
    assert [g[1] for g in got] == edges[:-1].tolist()
    assert [g[2] for g in got] == edges[1:].tolist()


def test_histogram_skips_nan(spark):
    df = spark.createDataFrame([(0.1,), (0.9,), (float("nan"),)], "prob_1 double")
    got = agg.probability_histogram(df).collect()
    assert sum(r["count"] for r in got) == 2
    assert min(r["lower"] for r in got) == 0.1 and max(r["upper"] for r in got) == 0.9


@pytest.mark.parametrize("bad", [float("inf"), float("-inf")])
def test_histogram_of_infinite_values_fails_as_in_numpy(spark, bad):
    df = spark.createDataFrame([(0.1,), (bad,)], "prob_1 double")
    with pytest.raises(ValueError):
        agg.probability_histogram(df)


def test_histogram_empty(spark):
    df = spark.createDataFrame([], "prob_1 double")
    got = agg.probability_histogram(df).collect()
    assert len(got) == 20 and sum(r["count"] for r in got) == 0


# --- confusion and metrics --------------------------------------------------------

def test_confusion_matrix_one_of_each(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0)],
                               "prediction double, is_fraud double")
    r = ev.confusion_matrix(df).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (1, 1, 1, 1)


def test_metrics_reference_numbers(spark):
    cm = spark.createDataFrame([FIXED_COUNTS], "tp long, fp long, tn long, fn long")
    r = ev.classification_metrics(cm).first()
    for name, want in FIXED_METRICS.items():
        assert r[name] == pytest.approx(want, abs=1e-4)


def test_metrics_guards_and_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), (0.0, None), (0.0, 0.0)],
                               "prediction double, is_fraud double")
    r = ev.evaluate_predictions(df).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (0, 0, 1, 0)
    assert (r["precision"], r["recall"], r["f1_score"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    empty = ev.evaluate_predictions(spark.createDataFrame([], "prediction double, is_fraud double"))
    e = empty.first()
    assert (e["tp"], e["fp"], e["tn"], e["fn"], e["accuracy"]) == (0, 0, 0, 0, None)


# --- AUC ----------------------------------------------------------------------------

def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1.0]
    neg = [s for y, s in pairs if y == 0.0]
    if not pos or not neg:
        return None
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_reference_fixture_is_one(spark):
    df = spark.createDataFrame(FIXED_SCORES, "is_fraud double, prob_1 double")
    assert ev.auc_exact(df).first()["auc"] == 1.0
    assert ev.auc_binned(df) == 1.0


@pytest.mark.parametrize("seed,parts", [(1, 80), (2, 7), (3, 1)])
def test_auc_exact_against_brute_force_and_mllib(spark, seed, parts):
    rnd = random.Random(seed)
    pairs = []
    for _ in range(600):
        y = 1.0 if rnd.random() < 0.3 else 0.0
        s = round(min(1.0, max(0.0, rnd.gauss(0.6 if y else 0.4, 0.2))), rnd.choice([2, 3, 6]))
        pairs.append((y, s))
    pairs += [(None, 0.5), (1.0, None), (2.0, 0.4)]       # not usable: left out
    df = spark.createDataFrame(pairs, "is_fraud double, prob_1 double")
    got = ev.auc_exact(df, partitions=parts).first()["auc"]
    clean = [(y, s) for y, s in pairs if y in (0.0, 1.0) and s is not None]
    assert got == pytest.approx(brute_auc(clean), rel=1e-12)
    mllib = ev.auc_binned(spark.createDataFrame(clean, "is_fraud double, prob_1 double"),
                          num_bins=0)
    assert got == pytest.approx(mllib, rel=1e-9)


def test_auc_skips_nan_scores(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.2), (1.0, float("nan")), (0.0, 0.5)],
                               "is_fraud double, prob_1 double")
    assert ev.auc_exact(df, partitions=5).first()["auc"] == 1.0


def test_auc_all_scores_equal_is_half(spark):
    df = spark.createDataFrame([(1.0, 0.4), (0.0, 0.4), (0.0, 0.4), (1.0, 0.4)],
                               "is_fraud double, prob_1 double")
    assert ev.auc_exact(df).first()["auc"] == 0.5


def test_auc_fewer_scores_than_partitions(spark):
    """Two distinct scores over five partitions: empty parts change nothing."""
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.1), (0.0, 0.9)], "is_fraud double, prob_1 double")
    assert ev.auc_exact(df, partitions=5).first()["auc"] == 0.75


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.7)], "is_fraud double, prob_1 double")
    assert ev.auc_exact(df).first()["auc"] is None


def test_top_risk_orders_and_breaks_ties(spark):
    df = spark.createDataFrame([(3, 0.9), (1, 0.9), (2, 0.5), (4, None), (5, 0.95)],
                               "transaction_id long, prob_1 double")
    assert [r[0] for r in ev.top_risk(df, 3).collect()] == [5, 1, 3]
