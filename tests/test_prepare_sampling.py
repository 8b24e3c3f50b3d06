"""Casts, label parsing (rules 5, 6, 10), vectors, and both splits (trap 6)."""

from __future__ import annotations

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskengine.operators import prepare as prep
from riskengine.operators import sampling
from riskengine.sources import testdata as td
from conftest import SF_MID


def test_preprocess_malformed_text_becomes_null(spark):
    df = spark.createDataFrame([("12.50", "2024-01-01 10:00:00"), ("abc", "not a time"),
                                (None, None)], "amount string, timestamp string")
    out = prep.preprocess(df)
    assert dict(out.dtypes) == {"amount": "double", "timestamp": "timestamp_ntz"}
    vals = [tuple(r) for r in out.collect()]
    assert vals[0][0] == 12.5 and vals[0][1].hour == 10
    assert vals[1] == (None, None) and vals[2] == (None, None)


def test_preprocess_leaves_typed_columns(spark):
    df = td.transactions(spark, SF_MID)
    assert prep.preprocess(df).dtypes == df.dtypes


@pytest.mark.parametrize("value,dtype,expected", [
    (True, "boolean", 1.0), (False, "boolean", 0.0),
    ("true", "string", 1.0), ("false", "string", 0.0),
    ("True", "string", None),            # case-sensitive, as the reference
    (1, "int", None),                    # an int label gives null, not an ANSI error
    (None, "string", None),
])
def test_label_to_double(spark, value, dtype, expected):
    df = spark.createDataFrame([(value,)], f"is_fraud {dtype}")
    assert prep.label_to_double(df).first()["is_fraud"] == expected


def test_label_to_int(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "is_fraud boolean")
    assert [r[0] for r in prep.label_to_int(df).collect()] == [1, 0, None]
    text = spark.createDataFrame([("1",), ("x",), ("true",), ("False",), ("0",)],
                                 "is_fraud string")
    assert [r[0] for r in prep.label_to_int(text).collect()] == [1, None, 1, 0, 0]


def test_assemble_rejects_null_feature(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        prep.assemble_features(df, ["a", "b"]).collect()
    kept = prep.assemble_features(df, ["a", "b"], handle_invalid="skip")
    assert kept.count() == 0


def test_flatten_probability(spark):
    df = spark.createDataFrame([(Vectors.dense([0.25, 0.75]),)], ["probability"])
    row = prep.flatten_probability(df).first()
    assert (row["prob_0"], row["prob_1"]) == (0.25, 0.75)


def _ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def test_stable_split_is_layout_independent(spark):
    df = td.transactions(spark, SF_MID)
    a3, b3 = sampling.stable_split(df.repartition(3))
    a7, b7 = sampling.stable_split(df.repartition(7))
    assert _ids(a3) == _ids(a7) and _ids(b3) == _ids(b7)
    n, na = df.count(), a3.count()
    assert na + b3.count() == n and 0.75 < na / n < 0.85


def test_stable_split_by_customer_keeps_histories_whole(spark):
    df = td.transactions(spark, SF_MID)
    labelled = sampling.stable_split(df, "customer_id", label_col="split")
    per_customer = labelled.groupBy("customer_id").agg(F.countDistinct("split").alias("sides"))
    assert per_customer.where("sides > 1").count() == 0


def test_random_split_partitions_the_rows(spark):
    df = td.transactions(spark, SF_MID)
    train, inference = sampling.random_split(df)
    assert train.count() + inference.count() == df.count()
    assert set(_ids(train)).isdisjoint(_ids(inference))


def test_stable_split_sends_null_keys_to_the_second_side(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "transaction_id long")
    first, second = sampling.stable_split(df)
    assert None not in _ids(first) and None in [r[0] for r in second.collect()]
    labelled = sampling.stable_split(df, label_col="split").where("transaction_id IS NULL")
    assert labelled.first()["split"] == "inference"


def test_split_weights_are_normalised():
    from riskengine.plans.pipelines import split_percent
    assert split_percent((4, 1)) == 80.0 and split_percent((0.805, 0.195)) == 80.5
    for bad in ((1,), (0.6, 0.2, 0.2), (0, 0), (-1, 2)):
        with pytest.raises(ValueError):
            split_percent(bad)


def test_stable_split_honours_fractions_of_a_percent(spark):
    df = spark.range(40_000).withColumnRenamed("id", "transaction_id")
    n = sampling.stable_split(df, percent=80.5)[0].count()
    assert abs(n / 40_000 - 0.805) < 0.01
    assert sampling.stable_split(df, percent=0.5)[0].count() in range(120, 290)
