"""Aggregations: class counts and weights, summaries, distributions, histogram.

Every statistic over many columns is one aggregate job (partial per task, one
small final merge), unpivoted afterwards inside the same plan -- never a job
per column.  The histogram's range comes to the driver as two numbers and returns
as literals; nothing row-sized passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType, StringType

from ..constants import HISTOGRAM_BINS, LABEL_COLUMN, PREDICTION_COLUMN, SCORE_COLUMN, WEIGHT_COLUMN
from ..functions.columns import label_int_of


def class_counts(df: DataFrame, label_col: str = LABEL_COLUMN) -> DataFrame:
    """A1: one row ``total, positive, negative`` (total includes null labels)."""
    lab = label_int_of(df, label_col)
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(lab == F.lit(1)).alias("positive"),
                  F.count_if(lab == F.lit(0)).alias("negative"))


def _weight(total: Column, n: Column, label_col: str) -> Column:
    absent = F.raise_error(F.lit(f"class absent from {label_col!r}")).cast("double")
    return F.when((total > 0) & (n == 0), absent).otherwise(total / (n * F.lit(2)))


def class_weights(df: DataFrame, label_col: str = LABEL_COLUMN) -> DataFrame:
    """One row ``positive_weight, negative_weight`` = ``total / (2 * n_class)``.

    Null when empty; the row fails when it is read if a class is absent (the weight would
    divide by zero).
    """
    total, pos, neg = (F.col(c) for c in ("total", "positive", "negative"))
    one = class_counts(df, label_col).where(total >= 0)
    return one.select(*[F.when(total > 0, _weight(total, n, label_col)).alias(out)
                        for n, out in ((pos, "positive_weight"), (neg, "negative_weight"))])


def add_class_weight(df: DataFrame, label_col: str = LABEL_COLUMN,
                     out: str = WEIGHT_COLUMN) -> DataFrame:
    """A2: per-row class weight; a null label takes the negative weight (as ``otherwise``).

    Lazy: the counts are a scalar subquery, run when the result is read.  An absent class
    fails then; an empty input gives no rows.
    """
    weights = class_weights(df, label_col).select(F.struct("positive_weight", "negative_weight")).scalar()
    return df.withColumn(out, F.when(label_int_of(df, label_col) == F.lit(1), weights["positive_weight"])
                         .otherwise(weights["negative_weight"]))


def _described_columns(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    if cols is not None:
        return list(cols)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (NumericType, StringType))]


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def _long_form(wide: DataFrame, rows: list[Column]) -> DataFrame:
    """Unpivot a one-row aggregate into one row per struct (inside the plan)."""
    return wide.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             digits: int | None = None) -> DataFrame:
    """A3: one row per column -- ``column, count, mean, stddev, min, max, min_text, max_text``.

    Numeric columns fill ``mean``, the sample ``stddev`` (null for one row) and
    ``min``/``max`` as doubles; ``min_text``/``max_text`` hold the exact extremes of
    integer and decimal columns (a double can't hold a long beyond 2^53) and those of
    text columns (byte order), like Spark's ``describe``.  All columns are summarised by
    one aggregate job.  Defaults to every numeric and string column.
    """
    names = _described_columns(df, cols)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, count bigint, mean double, stddev double, min double, "
                "max double, min_text string, max_text string")
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    aggs, rows = [], []
    null_d, null_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    for i, c in enumerate(names):
        aggs.append(F.count(c).alias(f"n{i}"))
        if isinstance(types[c], StringType):
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            stats = [null_d, null_d, null_d, null_d, F.col(f"lo{i}"), F.col(f"hi{i}")]
        else:
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                     F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
            exact = isinstance(types[c], (IntegralType, DecimalType))
            stats = [_round(F.col(f"m{i}"), digits), _round(F.col(f"s{i}"), digits), lo.cast("double"), hi.cast("double"),
                     *((lo.cast("string"), hi.cast("string")) if exact else (null_s, null_s))]
        names_out = ("mean", "stddev", "min", "max", "min_text", "max_text")
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                             *[e.alias(n) for e, n in zip(stats, names_out)]))
    return _long_form(df.agg(*aggs), rows)


def feature_distribution(df: DataFrame, feature_columns: Sequence[str],
                         digits: int | None = None) -> DataFrame:
    """A4: ``feature, mean, stddev, count`` per feature, all features in one job."""
    if not feature_columns:
        return df.sparkSession.createDataFrame(
            [], "feature string, mean double, stddev double, count bigint")
    aggs = []
    for i, c in enumerate(feature_columns):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.count(c).alias(f"n{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"),
                     _round(F.col(f"m{i}"), digits).alias("mean"),
                     _round(F.col(f"s{i}"), digits).alias("stddev"),
                     F.col(f"n{i}").alias("count"))
            for i, c in enumerate(feature_columns)]
    return _long_form(wide, rows)


def _total(count_col: str | None) -> Column:
    """Rows of a group; with ``count_col`` a row stands for so many."""
    return F.count(F.lit(1)) if count_col is None else F.coalesce(F.sum(count_col), F.lit(0))


def prediction_distribution(df: DataFrame, prediction_col: str = PREDICTION_COLUMN,
                            count_col: str | None = None) -> DataFrame:
    """A5: rows per predicted class (``prediction, count``)."""
    return df.groupBy(prediction_col).agg(_total(count_col).alias("count"))


def histogram_range(df: DataFrame, col: str = SCORE_COLUMN) -> tuple[float, float]:
    """Range numpy's ``histogram`` would use: [min, max], widened by 0.5 when they meet,
    [0, 1] when empty; ``ValueError`` when a value is infinite.  One min/max aggregate."""
    v = F.col(col).try_cast("double")
    some = F.when(~F.isnan(v), v)
    row = df.agg(F.min(some).alias("lo"), F.max(some).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return 0.0, 1.0
    if math.isinf(lo) or math.isinf(hi):
        raise ValueError(f"{col!r} holds infinite values: [{lo}, {hi}]")
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return lo, hi


def probability_histogram(df: DataFrame, col: str = SCORE_COLUMN,
                          bins: int = HISTOGRAM_BINS, count_col: str | None = None) -> DataFrame:
    """Equal-width histogram, ``bin, lower, upper, count`` for every bin (empty ones too).

    Bin edges are ``lo + i * step`` with the last edge ``hi``; a value goes to the
    bin whose edges hold it, the last bin closed -- the rule of ``numpy.histogram``.
    Null and NaN values are not counted; infinite ones are an error, as in numpy.

    Two aggregates over the input: its range, then the counts by bin, where each task
    sends ``bins`` rows at most.  No value leaves the executors.  An input that is dear to
    compute is better given as its written counts (``evaluation.outcome_counts``) with
    ``count_col``.
    """
    lo, hi = histogram_range(df, col)
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i >= F.lit(bins), F.lit(hi)).otherwise(i.cast("double") * F.lit(step)
                                                               + F.lit(lo))

    v = F.col("v")
    guess = F.least(F.greatest(
        F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))), F.lit(0)),
        F.lit(bins - 1))
    fixed = (F.when(v < edge(guess), guess - 1)
             .when((v >= edge(guess + 1)) & (guess != F.lit(bins - 1)), guess + 1)
             .otherwise(guess))
    rows = (F.lit(1) if count_col is None else F.col(count_col)).cast("long")
    counts = (df.select(F.col(col).try_cast("double").alias("v"), rows.alias("n"))
              .where((v >= F.lit(lo)) & (v <= F.lit(hi)))  # drops null and NaN
              .groupBy(fixed.cast("int").alias("bin")).agg(F.sum("n").alias("count")))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    b = F.col("bin")
    # ``counts`` holds at most ``bins`` rows: a proven bound for the broadcast.
    return (all_bins.join(F.broadcast(counts), "bin", "left")
            .select(b, edge(b).alias("lower"), edge(b + 1).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))
