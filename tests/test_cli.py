"""The command line runs the seven steps in the reference's order."""

from __future__ import annotations

import json
import os
import tempfile

from riskengine.__main__ import main
from riskengine.sources import io
from riskengine.sources import testdata as td
from conftest import SF_SMALL


def test_cli_runs_all_steps(spark, capsys):
    base = tempfile.mkdtemp(prefix="riskengine-cli-")
    p = {k: os.path.join(base, k) for k in
         ("raw", "train", "inf", "train_f", "inf_f", "model", "scored", "labels")}
    io.write_csv(td.transactions(spark, SF_SMALL), p["raw"])
    run = lambda *a: main(["--local", "2", *a])                       # noqa: E731
    assert run("split", p["raw"], p["train"], p["inf"], "--stable-key", "transaction_id") == 0
    assert run("features", p["train"], p["train_f"]) == 0
    assert run("features", p["inf"], p["inf_f"]) == 0
    capsys.readouterr()
    assert run("train", p["train_f"], p["model"]) == 0
    trained = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(trained["avg_auc"]) == {"0.01", "0.1", "1.0"} and 0 <= trained["auc"] <= 1
    assert run("score", p["inf_f"], p["model"], p["scored"]) == 0
    assert run("labels", p["inf_f"], p["labels"]) == 0
    capsys.readouterr()
    assert run("monitor", p["scored"], p["labels"]) == 0
    monitored = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    n_inf = spark.read.option("header", "true").csv(p["inf"]).count()
    assert sum(r["count"] for r in monitored["predictions"]) == n_inf
    assert run("evaluate", p["scored"], p["labels"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    m = report["metrics"]
    assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == n_inf and len(report["histogram"]) == 20


def test_cli_on_the_raw_file_layout(spark, capsys):
    """Text ids, text timestamps and "true"/"false" labels, as the reference's files."""
    from pyspark.sql import functions as F
    base = tempfile.mkdtemp(prefix="riskengine-cli-raw-")
    p = {k: os.path.join(base, k) for k in
         ("raw", "train", "inf", "train_f", "inf_f", "model", "scored", "labels")}
    ev = td.table(spark, SF_SMALL, "events")
    ev.select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("transaction_id"),
        F.concat(F.lit("CUST_"), F.lpad(F.col("user_id").cast("string"), 8, "0"))
        .alias("customer_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("value").alias("amount"), F.col("event_type").alias("merchant_category"),
        F.lit("US").alias("merchant_country"), F.lit(True).alias("card_present"),
        F.when(F.col("value") > 150, "true").otherwise("false").alias("is_fraud"),
    ).write.option("header", "true").csv(p["raw"])
    run = lambda *a: main(["--local", "2", *a])                       # noqa: E731
    assert run("split", p["raw"], p["train"], p["inf"], "--stable-key", "customer_id",
               "--raw-layout") == 0
    assert run("features", p["train"], p["train_f"], "--raw-layout") == 0
    assert run("features", p["inf"], p["inf_f"], "--raw-layout") == 0
    assert run("train", p["train_f"], p["model"]) == 0
    assert run("score", p["inf_f"], p["model"], p["scored"]) == 0
    assert run("labels", p["inf_f"], p["labels"]) == 0
    capsys.readouterr()
    assert run("evaluate", p["scored"], p["labels"]) == 0
    m = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["metrics"]
    n_inf = spark.read.option("header", "true").csv(p["inf"]).count()
    assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == n_inf
    ids = spark.read.option("header", "true").csv(p["scored"]).select("transaction_id").first()[0]
    assert len(ids) == 12                                               # text ids keep zeros
