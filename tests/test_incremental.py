"""Feature stores that grow by batches, and tables bucketed for windows and joins."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
import tempfile

import pytest

from riskengine.operators import evaluation as ev
from riskengine.operators import features as feat
from riskengine.plans import incremental as inc
from riskengine.sources import bucketed
from conftest import rows_of

SCHEMA = "transaction_id long, customer_id long, timestamp timestamp_ntz, amount double, merchant_category string"
DAY = 86400
START = dt.datetime(2024, 1, 4)


def row(i, customer, second, amount=1.0, category="a"):
    return (i, customer, None if second is None else START + dt.timedelta(seconds=second), amount, category)


def random_rows(seed, n=400):
    rnd = random.Random(seed)
    return [row(i, rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([None, rnd.randrange(60 * DAY), 7 * DAY * rnd.randrange(8)]),
                round(rnd.uniform(1, 90), 2), rnd.choice(["a", "b", None])) for i in range(n)]


@pytest.fixture
def store():
    return os.path.join(tempfile.mkdtemp(prefix="riskengine-store-"), "features")


def full(spark, rows):
    return rows_of(feat.full_feature_engineering(spark.createDataFrame(rows, SCHEMA)))


def stored(spark, store):
    return rows_of(inc.feature_table(spark, store))


@pytest.mark.parametrize("seed,heavy_rows", [(1, 100_000), (2, 50)])
def test_late_and_repeated_batches_equal_a_full_run(spark, store, seed, heavy_rows):
    rows = random_rows(seed) + [row(900, 2, 5 * DAY), row(900, 2, 5 * DAY)]
    parts = [rows[0::3], rows[1::3], rows[2::3]]
    for i in (2, 0, 0, 1, 2):  # out of order, two of them again
        inc.apply_batch(spark, store, spark.createDataFrame(parts[i], SCHEMA), f"b{i}", heavy_rows=heavy_rows)
    assert stored(spark, store) == full(spark, rows)
    assert inc.feature_table(spark, store).columns == feat.full_feature_engineering(spark.createDataFrame([], SCHEMA)).columns


def test_a_batch_rewrites_its_weeks_and_the_next_ones_only(spark, store):
    old = [row(i, i % 5, 10 * DAY * (i % 6)) for i in range(60)]
    inc.apply_batch(spark, store, spark.createDataFrame(old, SCHEMA), "old")
    before = set(glob.glob(f"{store}/rows/_week=*/*.parquet"))
    new = [row(100, 1, 20 * DAY + 1), row(101, 9, 20 * DAY)]
    weeks = inc.apply_batch(spark, store, spark.createDataFrame(new, SCHEMA), "new")
    after = set(glob.glob(f"{store}/rows/_week=*/*.parquet"))
    touched = {os.path.basename(os.path.dirname(p)) for p in before ^ after}
    assert len(weeks) == 1 and touched <= {f"_week={weeks[0]}", f"_week={weeks[0] + 1}"} and len(before & after) >= 4
    assert stored(spark, store) == full(spark, old + new)


def test_a_batch_that_failed_halfway_is_given_again(spark, store, monkeypatch):
    first, second = random_rows(3, 90), random_rows(4, 90)
    inc.apply_batch(spark, store, spark.createDataFrame(first, SCHEMA), "1")
    replace = inc._replace

    def fails_on_counts(df, path, by):
        if path.endswith("counts"):
            raise RuntimeError("lost")
        replace(df, path, by)

    monkeypatch.setattr(inc, "_replace", fails_on_counts)
    with pytest.raises(RuntimeError):
        inc.apply_batch(spark, store, spark.createDataFrame(second, SCHEMA), "2")
    monkeypatch.setattr(inc, "_replace", replace)
    inc.apply_batch(spark, store, spark.createDataFrame(second, SCHEMA), "2")
    assert stored(spark, store) == full(spark, first + second)


def test_empty_batches_and_other_columns(spark, store):
    empty = spark.createDataFrame([], SCHEMA)
    assert inc.apply_batch(spark, store, empty, "none") == []
    with pytest.raises(ValueError):
        inc.apply_batch(spark, store, empty.drop("amount").selectExpr("*", "1 AS amount"), "other")
    rows = random_rows(5, 30)
    inc.apply_batch(spark, store, spark.createDataFrame(rows, SCHEMA), "some")
    inc.apply_batch(spark, store, empty, "none")
    assert stored(spark, store) == full(spark, rows)


def test_no_store_is_an_error(spark, store):
    with pytest.raises(ValueError, match="no feature store"):
        inc.feature_table(spark, store)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordinary_customers_are_read_without_an_exchange(spark, store):
    rows = random_rows(6)
    df = spark.createDataFrame(rows, SCHEMA)
    table = bucketed.write_customer_table(df, "customers_of_test", store, buckets=4, heavy_rows=100)
    assert {r.customer_id for r in table.heavy.collect()} == {1}
    assert rows_of(feat.table_features(table.ordinary, table.heavy)) == full(spark, rows)
    kw = dict(customer_col="customer_id", seconds_col="timestamp_seconds", id_col="transaction_id", amount_col="amount",
              window_seconds=7 * DAY, count_out="n", sum_out="s", amount_scale=None)
    profile = dict(customer_col="customer_id", category_col="merchant_category", id_col="transaction_id")
    plan = _plan(feat._ordinary_features(table.ordinary, kw, profile))
    assert "Window" in plan and "Bucketed: true" in plan and "Exchange" not in plan
    spark.sql("DROP TABLE customers_of_test"), spark.sql("DROP TABLE customers_of_test_heavy")


def test_bucketed_sides_join_without_an_exchange(spark, store):
    ids = spark.range(500).selectExpr("id AS transaction_id")
    scored = bucketed.write_bucketed(ids.selectExpr("*", "transaction_id / 500D AS prob_1"), "scored_of_test", f"{store}/s",
                                     ["transaction_id"], buckets=4)
    truth = bucketed.write_bucketed(ids.selectExpr("*", "transaction_id % 2D AS is_fraud"), "truth_of_test", f"{store}/t",
                                    ["transaction_id"], buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = ev.join_truth(scored, truth)
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE scored_of_test"), spark.sql("DROP TABLE truth_of_test")
