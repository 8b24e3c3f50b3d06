"""Window features: rules 1-4 of the survey, and bucketed == direct (the reference's window)."""

from __future__ import annotations

import datetime as dt
import random
from fractions import Fraction

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from riskengine.operators import features as feat
from conftest import rows_of

SCHEMA = ("transaction_id long, customer_id long, timestamp timestamp_ntz, amount double, "
          "merchant_category string")
EPOCH = dt.datetime(1970, 1, 1)
W = 604800


def at(seconds):
    return None if seconds is None else EPOCH + dt.timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, c, at(s), a, m) for i, c, s, a, m in rows], SCHEMA)


def both_ways(df, fn, **kw):
    return fn(df, method="bucketed", **kw), fn(df, method="direct", **kw)


def rounded(df, *cols):
    """Rows with the amounts' sums to six places: the plain window sums doubles."""
    sums = [c for c in ("amount_velocity",) if c in df.columns]
    return rows_of(df.withColumns({c: F.round(c, 6) for c in sums}), *cols)


EDGE_ROWS = [
    # id, customer, seconds, amount, category
    (1, 7, 0, 10.00, "a"),
    (2, 7, W, 20.00, "a"),          # exactly W after row 1: row 1 is in its frame
    (3, 7, W + 1, 30.00, "b"),      # W + 1 after row 1: row 1 is out
    (4, 7, W + 1, 5.25, "b"),       # peer of row 3 (same second)
    (5, 7, None, 1.00, "a"),        # null time: peers only with other null times
    (6, 7, None, None, "a"),        # null amount
    (None, 7, 5, 2.00, "a"),        # null id: not counted, amount summed
    (8, None, 100, 3.00, "c"),      # null customer: a group of its own
    (9, None, 200, 4.00, "c"),
    (10, 8, 3 * W, 7.50, None),     # null category
]


def test_velocity_edges_match_reference_window(spark):
    df = frame(spark, EDGE_ROWS)
    got, ref = both_ways(df, feat.velocity_features)
    cols = ["transaction_id", "customer_id", "timestamp_seconds", "transaction_velocity",
            "amount_velocity"]
    assert rounded(got, *cols) == rounded(ref, *cols)
    by_id = {r["transaction_id"]: r for r in got.collect() if r["transaction_id"] is not None}
    assert by_id[1]["transaction_velocity"] == 1          # [-W, 0]: only itself (id null at 5 s is later)
    assert by_id[2]["transaction_velocity"] == 2          # rows 1 and 2 (the null id is not counted)
    assert by_id[2]["amount_velocity"] == 32.0            # ... but its amount is summed
    assert by_id[3]["transaction_velocity"] == 3          # 2, 3, 4 -- not 1
    assert by_id[3]["amount_velocity"] == 57.25
    assert by_id[4]["transaction_velocity"] == 3          # peers see each other
    assert by_id[5]["transaction_velocity"] == 2          # the two null-time rows
    assert by_id[5]["amount_velocity"] == 1.0             # null amount skipped
    assert by_id[8]["transaction_velocity"] == 1 and by_id[9]["transaction_velocity"] == 2
    assert by_id[10]["transaction_velocity"] == 1


def test_category_profile_edges(spark):
    df = frame(spark, EDGE_ROWS)
    got = feat.merchant_category_profiling(df, method="grouped")
    ref = feat.merchant_category_profiling(df, method="direct")
    cols = ["transaction_id", "customer_id", "merchant_category", "merchant_category_count"]
    assert rows_of(got, *cols) == rows_of(ref, *cols)
    by_id = {r["transaction_id"]: r["merchant_category_count"] for r in got.collect()}
    assert by_id[1] == 4          # ids 1, 2, 5, 6 in (7, a); the null id is not counted
    assert by_id[3] == 2
    assert by_id[8] == 2
    assert by_id[10] == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bucketed_equals_direct_on_skewed_random_data(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(3000):
        # one hot customer holds about a third of the rows
        cust = 0 if rnd.random() < 0.34 else rnd.randrange(1, 40)
        secs = rnd.choice([rnd.randrange(0, 6 * W), rnd.randrange(0, 6) * W,
                           rnd.randrange(0, 6) * W - 1])
        amount = round(rnd.uniform(1, 500), 2)
        rows.append((i, cust, secs, amount, rnd.choice("abcde")))
    df = frame(spark, rows)
    got, ref = both_ways(df, feat.full_feature_engineering)
    assert got.columns == ref.columns
    assert rounded(got) == rounded(ref)


def test_full_feature_columns_in_reference_order(spark):
    df = frame(spark, EDGE_ROWS[:3])
    out = feat.full_feature_engineering(df)
    assert out.columns == ["transaction_id", "customer_id", "timestamp", "amount",
                           "merchant_category", "timestamp_seconds", "transaction_velocity",
                           "amount_velocity", "merchant_category_count", "hour_of_day",
                           "day_of_week"]
    types = dict(out.dtypes)
    assert types["transaction_velocity"] == "bigint"
    assert types["amount_velocity"] == "double"
    assert types["merchant_category_count"] == "bigint"


def test_time_patterns_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 13, 5),),     # a Sunday
                                (dt.datetime(2024, 1, 6, 23, 59),)],   # a Saturday
                               "timestamp timestamp_ntz")
    got = [tuple(r) for r in feat.time_based_patterns(df).orderBy("timestamp").collect()]
    assert [(r[1], r[2]) for r in got] == [(23, 7), (13, 1)]


def test_features_from_raw_text_rows(spark):
    """Text timestamps and text ids through preprocess: a third row just outside the week."""
    df = spark.createDataFrame(
        [("a", "C1", "2024-03-01 23:59:59", 12.5, "fuel"), ("b", "C1", "2024-03-05 00:00:00", 7.25, "fuel"),
         ("c", "C1", "2024-03-09 00:00:00", 1.0, "books"), ("d", "C2", "2024-03-05 00:00:00", 3.0, "fuel")],
        "transaction_id string, customer_id string, timestamp string, amount double, merchant_category string")
    from riskengine.operators.prepare import preprocess
    got = {r["transaction_id"]: r for r in feat.full_feature_engineering(preprocess(df)).collect()}
    assert [got[x]["transaction_velocity"] for x in "abcd"] == [1, 2, 2, 1]
    assert [got[x]["amount_velocity"] for x in "abcd"] == [12.5, 19.75, 8.25, 3.0]
    assert [got[x]["merchant_category_count"] for x in "abcd"] == [2, 2, 1, 1]
    assert (got["a"]["hour_of_day"], got["a"]["day_of_week"]) == (23, 6)


def test_amounts_are_not_rounded(spark):
    rows = [(i, 1, i, 0.004, "a") for i in range(3)] + [(3, 2, 0, 1e17, "a"), (4, 2, 1, 0.1234567891, "a"),
                                                        (5, 2, 2 * W, 0.000001, "a")]
    got, ref = both_ways(frame(spark, rows), feat.amount_velocity)
    assert rounded(got) == rounded(ref)
    by_id = {r["transaction_id"]: r["amount_velocity"] for r in got.collect()}
    assert [by_id[i] for i in range(3)] == [0.004, 0.008, 0.012]
    assert by_id[3] == 1e17 and by_id[5] == 0.000001
    cents = feat.amount_velocity(frame(spark, rows[:3]), amount_scale=2)
    assert {r["amount_velocity"] for r in cents.collect()} == {0.0}    # only where it is asked for


def test_nan_and_infinite_amounts_stay_in_their_frames(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, 0, 1.0, "a"), (1, 1, 10, nan, "a"), (2, 1, 20, 2.0, "a"), (3, 1, W + 11, 4.0, "a"),
            (4, 2, 0, inf, "a"), (5, 2, 5, 1.0, "a"), (6, 2, 9, -inf, "a"), (7, 2, W + 1, 3.0, "a"),
            (8, 2, W + 10, 5.0, "a"), (9, 3, 0, None, "a"), (10, 4, 0, -1e30, "a"), (11, 4, W + 1, 2.5, "a")]
    got, ref = both_ways(frame(spark, rows), feat.amount_velocity)
    a, b = ({r["transaction_id"]: r["amount_velocity"] for r in x.collect()} for x in (got, ref))
    same = lambda x, y: x == y or (x is not None and y is not None and math.isnan(x) and math.isnan(y))
    assert all(same(a[i], b[i]) for i in range(10)), (a, b)
    assert a[10] == -inf and a[11] == 2.5                # beyond the decimals: infinite, in its frame only


def _exact_windows(rows, window):
    """Sums over the trailing window in exact arithmetic, rounded once."""
    out = {}
    for i, cust, secs, *_ in rows:
        own = [Fraction(repr(r[3])) for r in rows if r[1] == cust and r[3] is not None and (
            r[2] is None if secs is None else r[2] is not None and secs - window <= r[2] <= secs)]
        out[i] = float(sum(own)) if own else None
    return out


@pytest.mark.parametrize("method", ["bucketed", "split"])
@pytest.mark.parametrize("days", [1, 30, 365, 4000])
def test_windows_of_any_length_and_amounts_of_any_size(spark, days, method):
    rnd = random.Random(days)
    rows = [(i, rnd.randrange(3), rnd.choice([None, rnd.randrange(0, 3 * days * 86400)]),
             rnd.choice([None, round(rnd.uniform(-500, 500), 2), 1e18, -3e18, 2.5e24, 7e29, -7e29, 0.01]), "a") for i in range(250)]
    got = feat.amount_velocity(frame(spark, rows), window_seconds=days * 86400, method=method, heavy_rows=90)
    want = _exact_windows(rows, days * 86400)
    for r in got.collect():
        a, b = r["amount_velocity"], want[r["transaction_id"]]
        assert (a is None and b is None) or a == pytest.approx(b, rel=1e-15, abs=1e-9), r


@pytest.mark.parametrize("heavy_rows", [0, 60, 61, 10_000])
def test_both_sides_of_the_heavy_bound_agree(spark, heavy_rows):
    """Customers of 60, 61 and a few rows, and the null one: the same rows whoever is heavy."""
    rnd = random.Random(11)
    rows = [(i, c, rnd.choice([None, rnd.randrange(0, 4 * W), W]), rnd.choice([None, round(rnd.uniform(1, 99), 2)]), rnd.choice(["a", "b", None]))
            for i, c in enumerate([1] * 60 + [2] * 61 + [None] * 62 + [3] * 5)]
    df = frame(spark, rows)
    told = {r["customer_id"] for r in feat.heavy_customers(df, heavy_rows=heavy_rows).collect()}
    assert told == {0: {1, 2, 3, None}, 60: {2, None}, 61: {None}, 10_000: set()}[heavy_rows]
    for fn in (feat.full_feature_engineering, feat.transaction_velocity, feat.amount_velocity, feat.velocity_features):
        assert rounded(fn(df, heavy_rows=heavy_rows)) == rounded(fn(df, method="direct")), fn.__name__


def test_running_category_profile_equals_the_plain_window(spark):
    rnd = random.Random(5)
    rows = EDGE_ROWS + [(100 + i, rnd.choice([7, 8, None]), rnd.choice([None, rnd.randrange(0, 5 * W), W]), 1.0,
                         rnd.choice(["a", None])) for i in range(300)]
    df = feat.with_timestamp_seconds(frame(spark, rows))
    plain = Window.partitionBy("customer_id", "merchant_category").orderBy("timestamp_seconds")
    want = df.withColumn("merchant_category_count", F.count("transaction_id").over(plain))
    assert rows_of(feat.merchant_category_profiling(df, running=True)) == rows_of(want)


def test_plan_has_no_customer_only_window(spark):
    """The bucketed plan never partitions a window by customer alone."""
    df = frame(spark, EDGE_ROWS)
    plan = feat.velocity_features(df, method="bucketed")._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan


def test_a_third_of_rows_are_copies_of_one_row(spark):
    """A group of copies holding a third of the rows: same answers as the plain window."""
    rnd = random.Random(7)
    rows = [(i, rnd.randrange(0, 20), rnd.randrange(0, 3 * W), round(rnd.uniform(1, 300), 2),
             rnd.choice("abc")) for i in range(1000)]
    rows += [(999999, 3, W + 17, 42.42, "b")] * 500          # 500 copies of one transaction
    df = frame(spark, rows)
    got, ref = both_ways(df, feat.full_feature_engineering)
    assert rounded(got) == rounded(ref)
    copy = [r for r in got.collect() if r["transaction_id"] == 999999]
    assert len(copy) == 500 and len({tuple(r) for r in copy}) == 1
    assert copy[0]["transaction_velocity"] >= 500


def test_pre_1970_and_far_apart_times(spark):
    """Negative epoch seconds floor into the right week; distant years never mix."""
    rows = [(1, 1, -W - 5, 1.0, "a"), (2, 1, -3, 2.0, "a"), (3, 1, 0, 3.0, "a"),
            (4, 1, W - 2, 4.0, "b"), (5, 1, 40 * 365 * 86400, 5.0, "b"),
            (6, 2, -2 * W, 6.0, "a"), (7, 2, -2 * W + 1, 7.0, "a")]
    df = frame(spark, rows)
    got, ref = both_ways(df, feat.full_feature_engineering)
    assert rounded(got) == rounded(ref)
    v = {r["transaction_id"]: r["transaction_velocity"] for r in got.collect()}
    # row 1 (-W-5) is just outside row 2's frame [-W-3, -3]; row 2 is outside row 4's
    assert (v[1], v[2], v[3], v[4], v[5], v[6], v[7]) == (1, 1, 2, 2, 1, 1, 2)
