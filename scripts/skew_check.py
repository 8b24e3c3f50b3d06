"""Measure the largest task under a hot customer: direct window vs bucketed plan.

    python scripts/skew_check.py [sf_dir]

A third of the driver's events (chosen by a hash of the event id) are given to
one customer, so one key holds a third of all rows.  Both feature plans run to
completion; Spark's event log (written to a fresh scratch folder) gives, per
plan, the most shuffle records any single task read, and the wall time.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskengine.operators import features as feat  # noqa: E402
from riskengine.session import ensure_checkpoint_dir  # noqa: E402
from riskengine.sources import testdata as td  # noqa: E402

HOT = -1


def hot_transactions(spark, sf_dir):
    return td.hot_customer_transactions(spark, sf_dir, hot_customer=HOT)


def task_records(log_dir: str) -> dict[int, int]:
    """Max shuffle records read by one task, per job group (one group per plan)."""
    out: dict[int, int] = {}
    stage_group: dict[int, int] = {}
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus"))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = int(ev.get("Properties", {}).get("spark.jobGroup.id", "-1") or -1)
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev["Stage ID"], -1)
                    m = ev.get("Task Metrics") or {}
                    n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    out[g] = max(out.get(g, 0), n)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
            .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "64")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             # thresholds scaled down to this data size, so AQE's skew split can show
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16KB")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    tx = hot_transactions(spark, sf_dir)
    total = tx.count()
    hot_rows = tx.where(F.col("customer_id") == HOT).count()
    for method in ("direct", "bucketed"):      # warm-up: JIT and code generation
        feat.full_feature_engineering(tx, method=method).write.format("noop") \
            .mode("overwrite").save()
    times = {}
    for group, method in enumerate(("direct", "bucketed")):
        spark.sparkContext.setJobGroup(str(group), method)
        t0 = time.perf_counter()
        feat.full_feature_engineering(tx, method=method).write.format("noop") \
            .mode("overwrite").save()
        times[method] = round(time.perf_counter() - t0, 2)
    # The final adaptive plan of the bucketed form: which joins AQE split for skew.
    final = feat.full_feature_engineering(tx, method="bucketed")
    final.collect()
    plan = final._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    skew_joins = plan.count("SortMergeJoin(skew=true)")
    spark.stop()
    records = task_records(log_dir)
    print(json.dumps({"sf": os.path.basename(sf_dir), "rows": total, "hot_customer_rows": hot_rows,
                      "shuffle_partitions": 64, "broadcast": "off",
                      "max_records_one_task": {"direct": records.get(0), "bucketed": records.get(1)},
                      "seconds": times, "joins_split_for_skew_by_aqe": skew_joins}))


if __name__ == "__main__":
    main(sys.argv)
