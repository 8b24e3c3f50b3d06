"""Helpers shared by the operators: words, scratch tables, hash counting, components.

Texts cross to Python as UTF-8 bytes, so words are split and lower-cased with ``bytes``
operations whatever the text holds; a null text has no words.
"""

from __future__ import annotations

import pickle
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path

#: Maps A-Z to a-z and leaves every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower-cases and turns every byte outside 0-9, a-z and 0x80-0xFF into a space.
ALNUM = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in LOWER)

#: What separates the two kinds of word, for native expressions.
ASCII_SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes | None, table: bytes | None = None) -> list[bytes]:
    """Words split at ASCII white space, after an optional byte translation."""
    if not text:
        return []
    return (text.translate(table) if table else text).split()


def utf8(df: DataFrame, column: str = "text"):
    """The column's UTF-8 bytes, for Python tasks (null stays null)."""
    return F.col(column).cast("string").cast("binary").alias(column)


def word_hashes(ws: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    h = xxhash.xxh64_intdigest
    return np.fromiter(map(h, ws), np.uint64, len(ws))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit hashes (splitmix64's finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lower_ascii(column):
    """Native lower-casing of A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Shared:
    """A value of bounded size for all tasks, broadcast as bytes that carry its classes.

    A broadcast object is pickled by reference, so workers would have to import its class;
    these bytes are pickled by value, like the tasks' functions, and workers need no copy of
    this package.
    """

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if "held" not in self.__dict__:
            self.held = pickle.loads(self.sent.value)
        return self.held

    def __getstate__(self):
        return {"sent": self.sent}

    def destroy(self) -> None:
        self.sent.destroy()


# --- scratch tables ---------------------------------------------------------------------

class Scratch:
    """Tables written to the shared checkpoint folder and read back.

    A written table survives the loss of executors and cuts the lineage.  ``drop`` removes
    one that no later step reads; those behind a returned DataFrame go at exit.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, name)
        self.saved: list[DataFrame] = []

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{len(self.saved)}"
        df.write.parquet(path)
        self.saved.append(self.spark.read.schema(df.schema).parquet(path))
        return self.saved[-1]

    def drop(self, *tables: DataFrame) -> None:
        drop_scratch(self.spark, *[f"{self.base}/{i}" for i, t in enumerate(self.saved) if any(t is x for x in tables)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(rows: DataFrame, order: str, limit: int) -> DataFrame:
    """``limit`` rows at most, those of the least hash ``order``; few others are moved for it."""
    n = rows.count()
    share = max(1, min(1 << 20, -(-2 * limit * (1 << 20) // max(1, n))))
    return rows.where(F.pmod(F.col(order), F.lit(1 << 20)) < share).orderBy(F.pmod(F.col(order), F.lit(1 << 20)), order).limit(limit)


def marked(rows: DataFrame, by: list[str], keys: DataFrame) -> DataFrame:
    """``rows`` with a column ``_maybe``: false where ``by`` are sure to be no row of ``keys``.

    Told by a broadcast bitmap of 2^26 bits at most, so a join may leave out the others instead of
    moving their texts; with more keys than that has room for, more rows are kept.
    """
    bits = 1 << min(26, max(10, (32 * keys.count()).bit_length()))  # in words of 64
    place = F.pmod(F.xxhash64(*by), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("_place"), F.lit(64)).cast("int"))
    masks = (keys.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word"))
             .agg(F.bit_or(bit).alias("_mask")))
    found = rows.withColumn("_place", place).join(F.broadcast(masks), F.shiftright("_place", 6) == F.col("_word"), "left")
    return found.select(*[F.col(c) for c in rows.columns],
                        F.coalesce(F.col("_mask").bitwiseAND(bit) != 0, F.lit(False)).alias("_maybe"))


# --- connected components ---------------------------------------------------------------

def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the least node.

    Alternating large-star and small-star rounds: every round is a grouped minimum (with
    map-side combine) and an equi-join back, which AQE splits where one node is hot.
    """
    edges = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                      F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        sign = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if sign[0] == 0 or sign == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = sign
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = scratch.save(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                         .alias("e")).select("e.a", "e.b").where("a <> b").distinct())
        small = scratch.save(small)
        scratch.drop(edges, large)
        edges = small


# --- counting 64-bit keys ---------------------------------------------------------------

def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys.astype(np.uint64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    if counts is None:
        return keys[first], np.diff(np.r_[first, len(keys)])
    return keys[first], np.add.reduceat(counts[order], first)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Even buckets of keys by their leading bits; they never decrease over sorted keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row for each bucket that has keys: its sorted keys and counts (of one task, 32 bits) as bytes."""
    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    some = [i for i in range(buckets) if cuts[i] < cuts[i + 1]]
    c32 = counts.astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()),
         pa.array([keys[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary()),
         pa.array([c32[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())],
        ["bucket", "keys", "counts"])


def unpacked(keys: list[bytes], counts: list[bytes], kind=np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """Merge packed rows of one bucket."""
    return tally(np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(counts), kind).astype(np.int64))


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
