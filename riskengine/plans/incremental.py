"""W4 / Q1 batch by batch: a feature table that takes new transactions without a full run.

A store is a folder with three tables:

* ``rows``: the transactions with their velocities, partitioned by the week of their second.  A frame
  ``[s - W, s]`` lies in the row's week and the one before, so a batch can change rows of its own weeks
  and of the weeks after them, and needs the weeks before them as history -- of its customers only;
* ``counts``: transactions by (customer, category) of each batch, partitioned by batch.  The category
  profile counts a customer's whole past and future, so a batch changes it on rows of any age; it is
  added up and joined when the table is read, and no old partition is rewritten for it;
* ``shape``: no rows, the columns of ``rows``.

:func:`apply_batch` computes the changed weeks, writes them to the shared folder, and then replaces
these partitions by Spark's dynamic partition overwrite.  Rows and counts carry the batch's name: a
batch given again (a rerun after a failure at any point, say) replaces what it wrote, so it must hold
the same rows.  Batches may come late or overlap in time.  A store takes one batch at a time.

Defined cases: rows without a second form a partition of their own, a null customer or category is a
value like others, repeated rows count as often as they come, an empty batch adds nothing, and columns
or types other than those of the first batch are an error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import VELOCITY_WINDOW_SECONDS
from ..functions.columns import null_safe_keys
from ..operators import features as feat
from ..operators import prepare as prep
from ..session import drop_scratch, scratch_path
from ..sources import io

WEEK, BATCH = "_week", "_batch"
VELOCITIES = ["transaction_velocity", "amount_velocity"]


def _table(store: str, name: str) -> str:
    return f"{store.rstrip('/')}/{name}"


def _shape(spark: SparkSession, store: str):
    """The schema of a store's rows, or None where there is no store."""
    try:
        return spark.read.parquet(_table(store, "shape")).schema
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _stored(spark: SparkSession, store: str, shape) -> DataFrame:
    return spark.read.schema(shape).parquet(_table(store, "rows"))


def _in_weeks(weeks: set[int], null_too: bool) -> Column:
    """Rows of some partitions; a filter on the partition column, so others are not listed or read."""
    known = F.col(WEEK).isin(sorted(weeks)) if weeks else F.lit(False)
    return known | F.col(WEEK).isNull() if null_too else known


def _of_customers(rows: DataFrame, customers: DataFrame, how: str) -> DataFrame:
    return rows.join(customers, null_safe_keys(rows, customers, [feat.CUSTOMER]), how)


def apply_batch(spark: SparkSession, store: str, batch: DataFrame, batch_id: str, *,
                window_seconds: int = VELOCITY_WINDOW_SECONDS, **velocity) -> list[int | None]:
    """Add ``batch`` (columns of raw transactions) to the store; the weeks whose partitions it replaced.

    A store keeps one ``window_seconds``, which is also the length of its partitions.
    """
    raw = feat.with_timestamp_seconds(batch)
    week = F.floor(F.col(feat.SECONDS) / F.lit(window_seconds)).cast("long")
    raw = raw.withColumns({WEEK: week, BATCH: F.lit(batch_id)})
    columns = raw.columns
    shape, known = feat.velocity_features(raw, window_seconds=window_seconds).schema, _shape(spark, store)
    if known is None:
        spark.createDataFrame([], shape).write.mode("overwrite").parquet(_table(store, "shape"))
        spark.createDataFrame([], shape).write.mode("append").parquet(_table(store, "rows"))
    elif {f.name: f.dataType for f in known} != {f.name: f.dataType for f in shape}:
        raise ValueError(f"the store holds {known.simpleString()}, not {shape.simpleString()}")

    parsed, staged = scratch_path(spark, "batch"), scratch_path(spark, "weeks")
    raw.write.parquet(parsed)
    new = spark.read.schema(raw.schema).parquet(parsed)
    found = [r[0] for r in new.select(WEEK).distinct().collect()]  # a row a partition
    null_too, weeks = None in found, {w for w in found if w is not None}
    changed = weeks | {w + 1 for w in weeks}
    needed = changed | {w - 1 for w in weeks}

    customers = new.select(feat.CUSTOMER).distinct()
    old = _stored(spark, store, known or shape).where(F.col(BATCH) != batch_id)
    history = _of_customers(old.where(_in_weeks(needed, null_too)).select(columns), customers, "left_semi")
    again = feat.velocity_features(history.unionByName(new), window_seconds=window_seconds, **velocity)
    others = _of_customers(old.where(_in_weeks(changed, null_too)), customers, "left_anti")
    (again.where(_in_weeks(changed, null_too)).unionByName(others).hint("rebalance", F.col(WEEK))
     .write.partitionBy(WEEK).parquet(staged))

    _replace(spark.read.schema(shape).parquet(staged), _table(store, "rows"), WEEK)
    counts = feat.category_counts(new).withColumn(BATCH, F.lit(batch_id))
    _replace(counts, _table(store, "counts"), BATCH)
    drop_scratch(spark, parsed, staged)
    return sorted(weeks) + [None] * null_too


def _replace(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions that ``df`` has rows of, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def feature_table(spark: SparkSession, store: str) -> DataFrame:
    """All features of a store's transactions, columns as :func:`full_feature_engineering` gives them."""
    shape = _shape(spark, store)
    if shape is None:
        raise ValueError(f"no feature store at {store!r}")
    rows = _stored(spark, store, shape).drop(WEEK, BATCH)
    of = {f.name: f.dataType.simpleString() for f in shape}
    keys = [feat.CUSTOMER, feat.CATEGORY]
    pairs = ", ".join(f"{k} {of[k]}" for k in keys)
    counts = (spark.read.schema(f"{pairs}, merchant_category_count long, {BATCH} string").parquet(_table(store, "counts"))
              .groupBy(*keys).agg(F.sum("merchant_category_count").alias("merchant_category_count")))
    raw = [f.name for f in shape if f.name in rows.columns and f.name not in VELOCITIES]
    whole = feat._attach(rows, counts, keys)
    return feat.time_based_patterns(whole.select(*[F.col(f"`{c}`") for c in raw], *VELOCITIES, "merchant_category_count"))


def incremental_feature_pipeline(spark: SparkSession, input_path: str, store: str, batch_id: str,
                                 schema=io.TRANSACTION_SCHEMA) -> list[int | None]:
    """Q1 for a new batch: raw CSV -> preprocess -> :func:`apply_batch`."""
    return apply_batch(spark, store, prep.preprocess(io.read_transactions(spark, input_path, schema)), batch_id)
