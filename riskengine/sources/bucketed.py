"""S3 / S5 laid out for the operators: bucketed tables that windows and joins read without an exchange.

:func:`write_bucketed` writes rows into hash buckets of their keys, each bucket one sorted file, so a
grouping, window or join on these keys needs no shuffle: J1 on two tables bucketed by transaction.

Transactions are bucketed by customer (:func:`write_customer_table`), where one customer may hold a
third of all rows and a bucket belongs to one task.  So heavy customers are told once, when the table is
written, and their rows are kept in an unbucketed table beside it; W1-W4 read the one without an
exchange and the other through the plan by weeks (:func:`features.table_features`).

Tables are entries of the session's catalog with files at a path of the caller's; with a metastore they
outlive the session and :func:`read_customer_table` finds them by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import HEAVY_ROWS
from ..operators import features as feat


@dataclass
class CustomerTable:
    """Transactions of ordinary customers, bucketed by customer, and those of heavy ones."""

    ordinary: DataFrame
    heavy: DataFrame


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], sort: list[str] | None = None,
                   buckets: int | None = None) -> DataFrame:
    """``df`` as the catalog's table ``name`` at ``path``, in ``buckets`` hash buckets of ``keys``.

    A bucket is one file (rows are sent to their buckets first), sorted by ``sort``; as many buckets as
    shuffle partitions unless told otherwise.  Two tables join without an exchange if they have equally many.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys]).write.format("parquet").mode("overwrite")
    writer = writer.bucketBy(buckets, *keys).sortBy(*(sort or keys)).option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def write_customer_table(df: DataFrame, name: str, path: str, buckets: int | None = None,
                         heavy_rows: int = HEAVY_ROWS) -> CustomerTable:
    """Transactions with their seconds, as tables ``name`` (bucketed by customer, sorted by second) and
    ``name_heavy`` (customers of more than ``heavy_rows`` rows and a fixed share of all, unbucketed)."""
    ordinary, heavy = feat._split(feat.with_timestamp_seconds(df), feat.CUSTOMER, heavy_rows)
    write_bucketed(ordinary, name, f"{path}/ordinary", [feat.CUSTOMER], [feat.CUSTOMER, feat.SECONDS], buckets)
    (heavy.write.format("parquet").mode("overwrite").option("path", f"{path}/heavy").saveAsTable(f"{name}_heavy"))
    return read_customer_table(df.sparkSession, name)


def read_customer_table(spark: SparkSession, name: str) -> CustomerTable:
    """S3: the two tables that :func:`write_customer_table` wrote."""
    return CustomerTable(spark.table(name), spark.table(f"{name}_heavy"))
