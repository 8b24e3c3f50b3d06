"""Checkpoint folder rules: read the session's setting, set one only where none exists."""

from __future__ import annotations

from riskengine.operators import evaluation as ev
import os

from riskengine.session import drop_scratch, ensure_checkpoint_dir, materialize, scratch_path


def test_existing_checkpoint_dir_is_kept(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current                                   # the test session has one
    assert ensure_checkpoint_dir(spark) == current
    assert ensure_checkpoint_dir(spark) == current   # and it is not replaced


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    base = spark.sparkContext.getCheckpointDir().rstrip("/")
    assert a != b and a.startswith(base) and b.startswith(base)


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    m = materialize(df)
    assert m.count() == 100
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan                       # reads the checkpoint, not the source


def test_scratch_is_removed_by_its_owner(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    drop_scratch(spark, path)
    assert not os.path.exists(local)


def test_auc_of_empty_input_is_null(spark):
    empty = spark.createDataFrame([], "is_fraud double, prob_1 double")
    assert ev.auc_exact(empty).first()["auc"] is None


def test_configured_checkpoint_dir_is_used(tmp_path):
    """A session started with ``spark.checkpoint.dir`` keeps it (a fresh JVM is needed)."""
    import subprocess
    import sys
    import textwrap
    root = __import__("os").path.dirname(__import__("os").path.dirname(__file__))
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {root!r})
        from pyspark.sql import SparkSession
        from riskengine.session import ensure_checkpoint_dir
        spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
        print("DIR=" + ensure_checkpoint_dir(spark))
        spark.stop()
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=300).stdout
    used = [line for line in out.splitlines() if line.startswith("DIR=")][0][4:]
    assert used.replace("file:", "").startswith(str(tmp_path))
