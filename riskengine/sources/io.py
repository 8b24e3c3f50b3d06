"""Sources and sinks: CSV and columnar files, fitted models.

Readers are lazy (no count, no schema inference pass unless asked); writers
overwrite, and run on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from ..operators.prepare import cast_columns
from ..session import materialize

CORRUPT = "_corrupt"  # the reader's column for lines that it can't parse

# Raw transactions as our tables carry them (ids are numbers here; the
# reference's text ids fit the same reader with a StringType schema).
TRANSACTION_SCHEMA = StructType([
    StructField("transaction_id", LongType()),
    StructField("customer_id", LongType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("amount", DoubleType()),
    StructField("merchant_category", StringType()),
    StructField("is_fraud", BooleanType()),
])

# The raw card-transaction files as the reference's notebooks read them: text
# ids ("CUST_########"), ISO country code, card-present flag, and the timestamp as
# text ("yyyy-MM-dd HH:mm:ss") for ``preprocess`` to parse.  Read with this schema
# the ids stay text (schema inference would turn all-digit ids into numbers).
RAW_CSV_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("amount", DoubleType()),
    StructField("merchant_category", StringType()),
    StructField("merchant_country", StringType()),
    StructField("card_present", BooleanType()),
    StructField("is_fraud", StringType()),
])

# Text forms that keep microseconds (the CSV default keeps milliseconds only).
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_transactions(spark: SparkSession, path: str, schema: StructType | None = TRANSACTION_SCHEMA,
                      infer_schema: bool = False) -> DataFrame:
    """CSV with a header.  An explicit schema by default: inference costs a full
    extra scan and turns all-digit text ids into numbers.  Timestamps are read by
    Spark's default parser, which takes both ``yyyy-MM-dd HH:mm:ss`` and the ISO
    form with microseconds that :func:`write_csv` produces."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_with_casts(spark: SparkSession, path: str, casts: dict[str, str]) -> DataFrame:
    """CSV read as text, then the columns named in ``casts`` cast in one projection
    (``try_cast``: malformed text becomes null)."""
    return cast_columns(spark.read.option("header", "true").csv(path), casts)


@dataclass
class CheckedRows:
    """Rows that could be read, and those that could not."""

    good: DataFrame
    bad: DataFrame


def read_checked(spark: SparkSession, path: str, schema: StructType = TRANSACTION_SCHEMA, header: bool = True,
                 quarantine: str | None = None) -> CheckedRows:
    """S1 with damaged lines kept apart: ``good`` rows of ``schema``, ``bad`` ones as ``file, line``.

    A line is bad if it has more or fewer fields than the schema, or a field that its type
    doesn't take; an empty field is null and good.  The parsed rows are written once to the shared
    folder and both sides read that; with ``quarantine`` the bad lines are written there (parquet).
    """
    if CORRUPT in schema.fieldNames():
        raise ValueError(f"{CORRUPT!r} is the name of the lines that can't be read")
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = materialize(spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE")
                         .option("columnNameOfCorruptRecord", CORRUPT).schema(wide).csv(path)
                         .withColumn("_file", F.input_file_name()))
    good = parsed.where(F.col(CORRUPT).isNull()).select(*[F.col(f"`{n}`") for n in schema.fieldNames()])
    return CheckedRows(good, _quarantined(parsed.where(F.col(CORRUPT).isNotNull())
                                          .select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line")), quarantine))


def read_with_casts_checked(spark: SparkSession, path: str, casts: dict[str, str],
                            quarantine: str | None = None) -> CheckedRows:
    """S2 with malformed fields kept apart: ``good`` rows cast, ``bad`` ones as text with the names of
    the columns that held text no cast took (``failed``, sorted)."""
    text = materialize(spark.read.option("header", "true").csv(path))
    names = sorted(casts)
    if "failed" in text.columns:
        raise ValueError("'failed' is the name of the columns that can't be cast")
    lost = [F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(casts[c]).isNull(), F.lit(c)) for c in names]
    told = text.withColumn("failed", F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>"))
    bad = told.where(F.size("failed") > 0).withColumn("failed", F.array_join("failed", ","))
    return CheckedRows(cast_columns(told.where(F.size("failed") == 0).drop("failed"), casts), _quarantined(bad, quarantine))


def _quarantined(bad: DataFrame, path: str | None) -> DataFrame:
    if path is None:
        return bad
    bad.write.mode("overwrite").parquet(path)
    return bad.sparkSession.read.schema(bad.schema).parquet(path)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: a feature table in a columnar format (``parquet`` by default; ``delta``
    where the Delta package is on the classpath)."""
    return spark.read.format(fmt).load(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; timestamps keep microseconds.  Vector columns must be
    flattened first (see ``flatten_probability``): CSV has no vector type."""
    (df.write.mode(mode).option("header", "true")
     .option("timestampNTZFormat", TIMESTAMP_TEXT).option("timestampFormat", TIMESTAMP_TEXT)
     .csv(path))


def write_features(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: list[str] | None = None) -> None:
    """Write a feature table; an empty path is an error."""
    if not path:
        raise ValueError("write_features needs a path to write to")
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_model(model, path: str) -> None:
    """Persist a fitted model (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> LogisticRegressionModel:
    """Load a fitted logistic-regression model."""
    return LogisticRegressionModel.load(path)
