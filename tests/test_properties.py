"""Property tests: the two re-planned operators equal their direct definitions on any input."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskengine.operators import evaluation as ev
from riskengine.operators import features as feat
from conftest import rows_of

W = 604800
EPOCH = dt.datetime(1970, 1, 1)
SETTINGS = settings(max_examples=int(__import__("os").environ.get("PROPERTY_EXAMPLES", "20")), deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])

# seconds cluster around bucket edges so frames cross them often
seconds = st.one_of(st.none(), st.integers(0, 4 * W),
                    st.sampled_from([0, W - 1, W, W + 1, 2 * W, 2 * W + 1, 3 * W - 1]))
row = st.tuples(st.one_of(st.none(), st.integers(0, 50)),         # id (nullable)
                st.one_of(st.none(), st.integers(0, 3)),          # customer (few, so hot)
                seconds,
                st.one_of(st.none(), st.integers(0, 99999).map(lambda c: c / 100)),
                st.sampled_from(["a", "b", None]))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=60))
def test_bucketed_velocity_equals_direct_window(spark, rows):
    df = spark.createDataFrame(
        [(i, c, None if s is None else EPOCH + dt.timedelta(seconds=s), a, m)
         for i, c, s, a, m in rows],
        "transaction_id long, customer_id long, timestamp timestamp_ntz, amount double, "
        "merchant_category string")
    got = feat.full_feature_engineering(df, method="bucketed")
    ref = feat.full_feature_engineering(df, method="direct")
    got, ref = (x.withColumn("amount_velocity", F.round("amount_velocity", 6)) for x in (got, ref))
    assert rows_of(got) == rows_of(ref)


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1.0]
    neg = [s for y, s in pairs if y == 0.0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from([0.0, 1.0]),
                                st.integers(0, 40).map(lambda k: k / 40)),
                      min_size=1, max_size=80),
       parts=st.sampled_from([1, 3, 10]))
def test_exact_auc_equals_pair_count(spark, pairs, parts):
    df = spark.createDataFrame(pairs, "is_fraud double, prob_1 double")
    got = ev.auc_exact(df, partitions=parts).first()["auc"]
    want = brute_auc(pairs)
    assert (got is None and want is None) or abs(got - want) < 1e-12


@SETTINGS
@given(values=st.lists(st.one_of(st.floats(0, 1, allow_nan=False),
                                 st.integers(0, 20).map(lambda k: k / 20)),
                       min_size=1, max_size=60),
       bins=st.sampled_from([1, 3, 20]))
def test_histogram_equals_numpy(spark, values, bins):
    import numpy as np
    from riskengine.operators import aggregates as agg
    df = spark.createDataFrame([(v,) for v in values], "prob_1 double")
    got = sorted((r["bin"], r["lower"], r["upper"], r["count"])
                 for r in agg.probability_histogram(df, bins=bins).collect())
    counts, edges = np.histogram(values, bins=bins)
    assert [g[3] for g in got] == counts.tolist()
    assert [g[1] for g in got] == edges[:-1].tolist()
    assert [g[2] for g in got] == edges[1:].tolist()


def _exact_metrics(pairs):
    """Counts of each (prediction, label) pair and the metrics as exact fractions."""
    n = Counter(pairs)
    hit, alarm, quiet, miss = n[1.0, 1.0], n[1.0, 0.0], n[0.0, 0.0], n[0.0, 1.0]
    share = lambda part, whole, empty: Fraction(part, whole) if whole else empty
    return ([hit, alarm, quiet, miss],
            [share(hit + quiet, hit + alarm + quiet + miss, None), share(hit, hit + alarm, 0), share(hit, hit + miss, 0),
             share(2 * hit, 2 * hit + alarm + miss, 0)])


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from([0.0, 1.0, None]),
                                st.sampled_from([0.0, 1.0, None])), max_size=40))
def test_metrics_equal_exact_fractions(spark, pairs):
    df = spark.createDataFrame(pairs, "prediction double, is_fraud double")
    r = ev.evaluate_predictions(df).first()
    counts, metrics = _exact_metrics(pairs)
    assert [r[c] for c in ("tp", "fp", "tn", "fn")] == counts
    for name, want in zip(("accuracy", "precision", "recall", "f1_score"), metrics):
        assert (r[name] is None) if want is None else abs(r[name] - float(want)) < 1e-12
