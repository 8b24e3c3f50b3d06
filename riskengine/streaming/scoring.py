"""The batch scoring pipeline run incrementally with Structured Streaming.

The reference is batch-only because of its platform.  Scoring (P9 -> L4 -> P7) is
row-wise and stateless, so the same operators apply unchanged to a streaming
DataFrame of feature rows; the prediction counts (A5) become a running
aggregate whose state lives in the query's checkpoint.  Each micro-batch is
scored on the executors; progress and state are kept in a checkpoint folder
under the session's shared ``spark.checkpoint.dir``, so a restarted query
resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..constants import FEATURE_COLUMNS
from ..operators import aggregates as agg
from ..operators import learning as ml
from ..operators import prepare as prep
from ..session import drop_scratch, scratch_path


def read_feature_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Feature files arriving in ``path`` as a stream (the schema is required)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def score_stream(model, features: DataFrame,
                 feature_columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """L4 + P7 on a stream of feature rows: ``transaction_id, customer_id, prob_0,
    prob_1, prediction`` per row."""
    return ml.score(model, prep.assemble_features(features, feature_columns))


def prediction_counts_stream(scored: DataFrame) -> DataFrame:
    """A5 as a running count per predicted class (complete or update output mode)."""
    return agg.prediction_distribution(scored)


def start_file_sink(scored: DataFrame, output_path: str, fmt: str = "parquet",
                    checkpoint_location: str | None = None,
                    available_now: bool = True) -> StreamingQuery:
    """Append scored rows to files.  ``available_now`` processes what has arrived and
    stops (a scheduled incremental batch); otherwise it runs continuously."""
    spark = scored.sparkSession
    checkpoint = checkpoint_location or scratch_path(spark, "scoring-stream")
    writer = (scored.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", output_path))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def start_table_sink(aggregated: DataFrame, output_path: str, fmt: str = "parquet",
                     checkpoint_location: str | None = None,
                     available_now: bool = True) -> StreamingQuery:
    """Keep the current result of a running aggregate as a table.

    Each micro-batch writes the complete aggregate (one row per group) to a folder of its
    own under ``output_path``; :func:`read_table_sink` reads the last complete one, so a
    reader never meets a table that is being replaced.  A batch replayed after a failure
    writes the same folder again; older folders than the last two are removed.
    """
    spark = aggregated.sparkSession
    checkpoint = checkpoint_location or scratch_path(spark, "counts-stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(_batch_path(output_path, batch_id))
        for old in _batches(spark, output_path):
            if old < batch_id - 1:
                drop_scratch(spark, _batch_path(output_path, old))

    writer = (aggregated.writeStream.outputMode("complete").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def _batch_path(output_path: str, batch_id: int) -> str:
    return f"{output_path}/batch-{batch_id:012d}"


def _batches(spark: SparkSession, output_path: str) -> list[int]:
    """Ids of the complete batches in a table sink's folder, in order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = jvm.org.apache.hadoop.fs.Path(f"{output_path}/batch-*/_SUCCESS")
    found = done.getFileSystem(conf).globStatus(done) or []
    return sorted(int(f.getPath().getParent().getName().removeprefix("batch-")) for f in found)


def read_table_sink(spark: SparkSession, output_path: str, fmt: str = "parquet") -> DataFrame:
    """The last complete result that :func:`start_table_sink` published in ``output_path``."""
    return spark.read.format(fmt).load(_batch_path(output_path, _batches(spark, output_path)[-1]))


def run_to_end(query: StreamingQuery, timeout_s: int = 900) -> None:
    """Wait for an ``availableNow`` query to finish; stop it and fail after ``timeout_s``."""
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
