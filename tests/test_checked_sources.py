"""Damaged CSV lines kept apart, and the statistics that read written counts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from riskengine.operators import aggregates as agg
from riskengine.operators import evaluation as ev
from riskengine.plans import pipelines as pl
from riskengine.sources import io
from conftest import rows_of

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("n", IntegerType())])


def test_bad_lines_are_kept_as_they_were(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('id,name,n\n1,a,2\nx,b,3\n2,,\n3,c\n4,d,5,6\n"5","q,r",7\n6,e,9999999999\n')
    (tmp_path / "in" / "b.csv").write_text("id,name,n\n7,f,8\n")
    got = io.read_checked(spark, str(tmp_path / "in"), SCHEMA, quarantine=str(tmp_path / "bad"))
    assert rows_of(got.good) == sorted([(1, "a", 2), (2, None, None), (5, "q,r", 7), (7, "f", 8)], key=repr)
    assert got.good.columns == ["id", "name", "n"]
    assert sorted(r["line"] for r in got.bad.collect()) == ["3,c", "4,d,5,6", "6,e,9999999999", "x,b,3"]
    assert all(r["file"].endswith("a.csv") for r in got.bad.collect())
    assert rows_of(spark.read.parquet(str(tmp_path / "bad"))) == rows_of(got.bad)


def test_only_good_only_bad_and_no_lines(spark, tmp_path):
    for name, text, good, bad in (("g", "1,a,2\n", 1, 0), ("b", "x,a,2\ny\n", 0, 2), ("e", "", 0, 0)):
        (tmp_path / name).write_text(text)
        got = io.read_checked(spark, str(tmp_path / name), SCHEMA, header=False)
        assert (got.good.count(), got.bad.count()) == (good, bad)
    with pytest.raises(ValueError, match="name"):
        io.read_checked(spark, str(tmp_path / "g"), StructType([StructField(io.CORRUPT, StringType())]))


def test_failed_casts_are_named(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,a,b\n1,1.5,2\n2,x,3\n3,,4\n4,y,z\n5,2.5,\n")
    got = io.read_with_casts_checked(spark, str(tmp_path / "s.csv"), {"b": "int", "a": "double"}, str(tmp_path / "bad"))
    assert rows_of(got.good) == sorted([("1", 1.5, 2), ("3", None, 4), ("5", 2.5, None)], key=repr)
    assert rows_of(got.bad) == sorted([("2", "x", "3", "a"), ("4", "y", "z", "a,b")], key=repr)
    (tmp_path / "f.csv").write_text("id,failed\n1,2\n")
    with pytest.raises(ValueError, match="failed"):
        io.read_with_casts_checked(spark, str(tmp_path / "f.csv"), {"id": "int"})
    none = io.read_with_casts_checked(spark, str(tmp_path / "s.csv"), {})
    assert (none.good.count(), none.bad.count()) == (5, 0)


def test_statistics_of_counts_equal_those_of_rows(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, float("nan"), 0.0, 0.25, 0.5, 0.75, 1.0]), rnd.choice([None, 0.0, 1.0]), rnd.choice([None, 0.0, 1.0, 2.0]))
            for i in range(900)]
    df = spark.createDataFrame(rows, "transaction_id long, prob_1 double, prediction double, is_fraud double")
    seen = ev.outcome_counts(df)
    assert seen.count() < 7 * 3 * 4 + 1 and seen.agg({"n": "sum"}).first()[0] == 900
    for fn, kw in ((ev.confusion_matrix, {}), (ev.evaluate_predictions, {}), (ev.auc_exact, {}), (agg.prediction_distribution, {}),
                   (agg.probability_histogram, {"bins": 7})):
        assert rows_of(fn(seen, count_col="n", **kw)) == rows_of(fn(df, **kw)), fn.__name__
    whole = df.where("prob_1 IS NOT NULL AND NOT isnan(prob_1) AND is_fraud IN (0.0, 1.0)")
    assert ev.auc_binned(ev.outcome_counts(whole), count_col="n") == pytest.approx(ev.auc_binned(whole), abs=1e-12)
    empty = ev.outcome_counts(df.limit(0))
    assert rows_of(ev.confusion_matrix(empty, count_col="n")) == [(0, 0, 0, 0)]
    assert ev.auc_exact(empty, count_col="n").first()["auc"] is None
    assert sum(r["count"] for r in agg.probability_histogram(empty, count_col="n").collect()) == 0


def test_pipelines_join_once(spark):
    scored = spark.createDataFrame([(i, 0.1 * (i % 10), float(i % 10 > 5)) for i in range(100)], "transaction_id long, prob_1 double, prediction double")
    labels = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(100)], "transaction_id long, is_fraud double")
    auc, dist = pl.monitoring(scored, labels)
    result = pl.evaluation(scored, labels)
    for df in (auc, dist, result.metrics, result.histogram):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert "transaction_id" not in plan  # what they read are the counts
    joined = ev.join_truth(scored, labels)
    assert rows_of(auc) == rows_of(ev.auc_exact(joined)) and rows_of(dist) == rows_of(agg.prediction_distribution(joined))
    assert rows_of(result.metrics) == rows_of(ev.evaluate_predictions(joined))
    assert pl.monitoring(scored, labels, "binned")[0].first()["auc"] == pytest.approx(ev.auc_binned(joined), abs=1e-12)
