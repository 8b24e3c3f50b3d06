"""Train / inference splits.

``random_split`` is the reference's Bernoulli split (``randomSplit``).  Its rows
depend on the input layout (partitioning and file order), so the same seed can
give other rows after a repartition.  ``stable_split`` decides each row from a
hash of its key and the seed alone: same rows on any layout, any cluster, and
in DuckDB (``md5`` is the same function in both engines).  Keyed by customer,
it keeps each customer's history on one side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SPLIT_BUCKETS, SPLIT_SEED, SPLIT_WEIGHTS


def random_split(df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS,
                 seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Bernoulli split into ``len(weights)`` tables (each re-scans the input)."""
    return df.randomSplit(list(weights), seed=seed)


def split_bucket(key: str | Column, seed: int = SPLIT_SEED) -> Column:
    """Integer in [0, SPLIT_BUCKETS) from ``md5(key || ':' || seed)`` -- layout-independent."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(SPLIT_BUCKETS))


def stable_split(df: DataFrame, key: str = "transaction_id", percent: float = 80,
                 seed: int = SPLIT_SEED, label_col: str | None = None,
                 labels: tuple[str, str] = ("train", "inference")) -> DataFrame | tuple:
    """Deterministic split by key hash; ``percent`` may have up to four decimals.

    With ``label_col`` the rows come back in one table with a split label column;
    without, as a (first, second) pair of filtered tables.  A null key goes to the
    second side.
    """
    inside = split_bucket(key, seed) < F.lit(round(percent * SPLIT_BUCKETS / 100))
    inside = F.coalesce(inside, F.lit(False))
    if label_col is not None:
        return df.withColumn(
            label_col, F.when(inside, F.lit(labels[0])).otherwise(F.lit(labels[1])))
    return df.where(inside), df.where(~inside)
