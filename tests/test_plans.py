"""Plan guards over every registered query: the shapes that would not survive 100 TB."""

from __future__ import annotations

import re

import pytest

from riskengine.plans.queries import REGISTRY
from conftest import SF_SMALL

FORBIDDEN = (
    "CartesianProduct",          # pairs of rows
    "BroadcastNestedLoopJoin",   # a join without equi-keys
    "BatchEvalPython",           # row-at-a-time Python UDF
    "ArrowEvalPython",           # vectorised Python UDF: not needed on any hot path
)


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_forbidden_operators(spark, name):
    plan = _plan(REGISTRY[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def test_scans_are_pruned(spark):
    """A query that needs two event columns reads only those (plus the join key)."""
    plan = _plan(REGISTRY["class_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<value:double>" in plan


def test_window_partitions_are_bounded(spark):
    """Every velocity window is partitioned by (customer, week bucket), or by the customer where
    heavy customers were taken out by an anti join; and its frames only grow (they start at the
    partition's first row) -- no frame with two moving ends, which Spark adds up anew for every row."""
    for name in ("transaction_velocity", "amount_velocity", "feature_engineering", "velocity_bucketed"):
        plan = _plan(REGISTRY[name](spark, SF_SMALL))
        windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
        assert any("_bucket" in line for line in windows), name
        for line in windows:
            frames = line.count("specifiedwindowframe(")
            growing = len(re.findall(r"specifiedwindowframe\((?:Range|Row)Frame, unboundedpreceding", line))
            assert frames == growing > 0, f"{name}: {line[:200]}"
            assert "_bucket" in line or ("LeftAnti" in plan and name != "velocity_bucketed"), f"{name}: {line[:200]}"


def test_label_filter_reaches_the_scan(spark):
    """The label is derived from ``value``; filtering on it pushes a filter into the scan."""
    plan = _plan(REGISTRY["label_slice"](spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,150.0)]" in scan


def test_queries_run_over_whole_tables():
    """Only the top-k report limits its rows; no SQL twin samples or caps its input."""
    import __spark_entry__ as entry
    for name, sql in entry.oracle_sql().items():
        capped = re.search(r"\bLIMIT\b|\bUSING\s+SAMPLE\b|\bTABLESAMPLE\b", sql, re.I)
        assert not capped or name == "top_risk", name


def test_aqe_splits_the_hot_category_join(spark):
    """With one customer holding a third of the rows, AQE splits the skewed join
    partitions (thresholds scaled down to the test data size)."""
    from riskengine.operators.features import full_feature_engineering
    from riskengine.sources.testdata import hot_customer_transactions
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "64"}
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = full_feature_engineering(hot_customer_transactions(spark, "/root/testdata/sf0.01"), method="bucketed")
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
