"""bench.py prints exactly one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEATS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "feature_engineering",
                          "top_risk"], capture_output=True, text=True, env=env, timeout=600,
                         cwd=ROOT).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert set(result) >= {"metric", "value", "unit", "queries", "sf"}
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"feature_engineering", "top_risk"}
    assert all(isinstance(v, float) for v in result["queries"].values())


def test_entry_from_a_plain_session_elsewhere(tmp_path):
    """The driver's smoke check: import the entry module by path, default session, other cwd."""
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = entry.entry(spark)
print("ROWS=%d COLS=%s" % (len(df.collect()), ",".join(df.columns)))
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         cwd=str(tmp_path), timeout=600).stdout
    line = [x for x in out.splitlines() if x.startswith("ROWS=")][0]
    assert line.startswith("ROWS=1000 ") and "transaction_velocity" in line
