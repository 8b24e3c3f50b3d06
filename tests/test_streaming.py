"""Incremental scoring gives the same rows as the batch scoring."""

from __future__ import annotations

import tempfile

from riskengine.operators import features as feat
from riskengine.operators import learning as ml
from riskengine.operators import prepare as prep
from riskengine.plans import pipelines as pl
from riskengine.sources import testdata as td
from riskengine.streaming import scoring as stream
from conftest import SF_SMALL, rows_of


def test_stream_scoring_matches_batch(spark):
    features = feat.full_feature_engineering(td.transactions(spark, SF_SMALL))
    model = ml.fit_logistic(pl.training_frame(features), reg_param=0.01, max_iter=5)
    base = tempfile.mkdtemp(prefix="riskengine-stream-")
    features.repartition(4).write.parquet(f"{base}/in")
    incoming = stream.read_feature_stream(spark, f"{base}/in", features.schema,
                                          max_files_per_trigger=1)
    q = stream.start_file_sink(stream.score_stream(model, incoming), f"{base}/out",
                               checkpoint_location=f"{base}/ckpt")
    stream.run_to_end(q, 600)
    streamed = spark.read.parquet(f"{base}/out")
    batch = ml.score(model, prep.assemble_features(features))
    assert rows_of(streamed) == rows_of(batch)


def test_running_prediction_counts(spark):
    base = tempfile.mkdtemp(prefix="riskengine-stream-")
    scored = td.scored(spark, SF_SMALL)
    scored.repartition(3).write.parquet(f"{base}/in")
    incoming = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{base}/in")
    q = (stream.prediction_counts_stream(incoming).writeStream.outputMode("complete")
         .format("memory").queryName("prediction_counts")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    stream.run_to_end(q, 600)
    got = {r["prediction"]: r["count"] for r in spark.table("prediction_counts").collect()}
    want = {r["prediction"]: r["count"] for r in
            scored.groupBy("prediction").count().collect()}
    assert got == want


def test_table_sink_publishes_whole_results(spark):
    """Three micro-batches: the last one's counts are read, and only the last two are kept."""
    import os
    base = tempfile.mkdtemp(prefix="riskengine-stream-")
    scored = td.scored(spark, SF_SMALL)
    scored.repartition(3).write.parquet(f"{base}/in")
    incoming = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    stream.run_to_end(stream.start_table_sink(stream.prediction_counts_stream(incoming), f"{base}/out",
                                              checkpoint_location=f"{base}/ckpt"), 600)
    assert rows_of(stream.read_table_sink(spark, f"{base}/out")) == rows_of(stream.prediction_counts_stream(scored))
    assert len(os.listdir(f"{base}/out")) == 2
