"""The README's quick start runs as written (on a raw-layout file made from the events)."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import functions as F

from riskengine.sources import testdata as td
from conftest import ROOT, SF_SMALL


def test_quick_start_runs(spark):
    readme = open(os.path.join(ROOT, "README.md")).read()
    code = re.search(r"## Quick start \(Python\)\n\n```python\n(.*?)```", readme, re.S).group(1)
    path = os.path.join(tempfile.mkdtemp(prefix="riskengine-readme-"), "transactions.csv")
    ev = td.table(spark, SF_SMALL, "events")
    ev.select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("transaction_id"),
        F.concat(F.lit("CUST_"), F.lpad(F.col("user_id").cast("string"), 8, "0"))
        .alias("customer_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("value").alias("amount"), F.col("event_type").alias("merchant_category"),
        F.lit("US").alias("merchant_country"), F.lit(True).alias("card_present"),
        F.when(F.col("value") > 150, "true").otherwise("false").alias("is_fraud"),
    ).write.option("header", "true").csv(path)
    scope = {"spark": spark}
    exec(code.replace('"transactions.csv"', repr(path)), scope)     # noqa: S102
    assert scope["joined"].count() > 0
    assert 0.0 <= scope["auc_exact"](scope["joined"]).first()["auc"] <= 1.0
