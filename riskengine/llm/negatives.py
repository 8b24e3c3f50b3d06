"""Hard negatives of anchors, by lists shared within anchor clusters and certified to be complete.

A row's score for an anchor is the inner product of their quantised vectors; higher comes first,
then the smaller id.  The positives of an anchor are its first rows of its own label, the hard
negatives of a positive the first rows of another label whose scores lie in a band below the
positive's.  Both are exact:

* Anchors are clustered by direction (spherical k-means on ``SAMPLE`` of them at most) and packed,
  cluster by cluster and outwards, into blocks of ``BLOCK``.
* In a task a block meets a set of candidates.  Their order by upper bound is made once for the
  block: with ``t`` the angle between a candidate and the block's centre and ``w`` the widest angle
  of a member, no member's score is above its own length times ``|x| cos(max(0, t - w))``.
* Every member walks that list in chunks and ends when its length times the next bound is below
  what could still enter its result: its last place, or the lower end of its lowest open band.

A block is a piece of the stated query set, so blocks meet all candidates: anchors in groups of
``GROUP`` at most and candidates in slots of about ``SLOT`` are shuffled to their (group, slot),
and the parts are merged by rank.  A task holds one group and one slot, whatever the labels.
Labels, copies and clusters are never shuffle keys, so none of them can be hot.

Defined cases: rows with a null label, a null vector, or a null or infinite component or NaN take
no part; nor do those whose quantised vector has a squared length of 2^62 or more, so that every
score fits a long.  Only vectors of the anchor's length are compared with it; very long ones cost
memory in proportion.  A null id is no anchor and comes last in ties.  Equal rows count each:
as anchors they give equal rows of the result, and one of them is another's other row.  An empty
table, or one without anchors, gives none.  Other columns are not read and may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bounded_sample

SAMPLE = 4096          # anchors that clusters are fitted to, at most
CLUSTERS = 64          # at most
BLOCK = 256            # anchors that share a list
GROUP, SLOT = 1 << 17, 1 << 17   # anchors and candidates in a task, about
SHARD = 2048           # candidates packed in one row
CHUNK = 512            # places of a list scored at once
STEPS = 12             # of k-means
NO_ID = (1 << 63) - 1  # stands for a null id: the last in ties
SLACK = 1 + 1e-9       # bounds are rounded up by it


# --- in numpy ---------------------------------------------------------------------------

def centroids(x: np.ndarray, k: int, seed: int = 13) -> np.ndarray:
    """Directions of ``k`` clusters at most (spherical k-means)."""
    x = unit(x)
    at = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(STEPS):
        own = (x @ at.T).argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, own, x)
        at = np.where(np.abs(sums).sum(axis=1, keepdims=True) > 0, unit(sums), at)
    return at


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


class Candidates:
    """The rows of a slot: ids, labels, integer vectors and their lengths."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.real = vectors.astype(np.float64)
        self.size = np.sqrt((self.real * self.real).sum(axis=1))


class SharedList:
    """A slot's candidates in the order of their upper bounds for one block of anchors."""

    def __init__(self, anchors: np.ndarray, slot: Candidates):
        self.anchors, self.slot = anchors, slot
        real = anchors.astype(np.float64)
        self.size = np.sqrt((real * real).sum(axis=1))
        centre = unit(unit(real).sum(axis=0, keepdims=True))[0]
        widest = np.arccos(np.clip((unit(real) @ centre).min(), -1, 1))
        towards = np.arccos(np.clip(slot.real @ centre / np.maximum(slot.size, 1e-300), -1, 1))
        # 1e-7: more than the arc cosine's error near 1
        bound = slot.size * np.cos(np.maximum(0, towards - widest - 1e-7)) * SLACK
        bound = np.where(bound < 0, bound / SLACK / SLACK, bound)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        # doubles add integer products exactly below 2^53
        self.exact = len(self.size) == 0 or len(slot.size) == 0 or self.size.max() * slot.size.max() < 2.0 ** 52
        self.real = real

    def scores(self, members: np.ndarray, places: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.real[members] @ self.slot.real[places].T).astype(np.int64)
        return self.anchors[members] @ self.slot.vectors[places].T

    def walk(self, take) -> int:
        """Give ``take(members, rows, scores)`` chunk by chunk; it returns the members' floors.

        A member ends when no later row can reach its floor.  Returns the scores computed.
        """
        members, done = np.arange(len(self.anchors)), 0
        floors = np.full(len(members), -np.inf)
        for lo in range(0, len(self.order), CHUNK):
            top = self.bound[lo]
            reach = np.where(top > 0, self.size * top * SLACK, self.size * top / SLACK)
            members = np.flatnonzero(reach >= floors)
            if not len(members):
                break
            rows = self.order[lo:lo + CHUNK]
            floors[members] = take(members, rows, self.scores(members, rows))
            done += len(members) * len(rows)
        return done


class Best:
    """The best ``k`` (score, id) seen."""

    __slots__ = ("k", "scores", "ids")

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
        keep = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[keep], ids[keep]


def first_of_label(anchors: np.ndarray, labels: np.ndarray, slot: Candidates, k: int) -> list[Best]:
    """The first ``k`` rows of each anchor's own label, the anchor's row among them."""
    best = [Best(k) for _ in anchors]

    def take(members, rows, scores):
        same = labels[members][:, None] == slot.labels[rows][None]
        floors = np.array([best[m].floor() for m in members])
        same &= scores >= floors[:, None]
        for i in np.flatnonzero(same.any(axis=1)).tolist():
            best[members[i]].add(scores[i, same[i]], slot.ids[rows[same[i]]])
            floors[i] = best[members[i]].floor()
        return floors

    SharedList(anchors, slot).walk(take)
    return best


def bands(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest integers n with low * s <= 100 * n <= high * s, without overflow."""
    s, r = scores // 100, scores % 100
    return low * s - (-low * r) // 100, high * s + high * r // 100


def first_in_bands(anchors: np.ndarray, labels: np.ndarray, positives: list[np.ndarray], slot: Candidates, k: int,
                   low: int, high: int) -> list[list[Best]]:
    """For each anchor and positive score, the first ``k`` rows of other labels in the score's band."""
    ranges = [list(zip(*(x.tolist() for x in bands(p, low, high)), strict=True)) for p in positives]
    best = [[Best(k) for _ in r] for r in ranges]

    def floor(m):
        return min((max(a, b.floor()) for (a, z), b in zip(ranges[m], best[m], strict=True) if a <= z), default=np.inf)

    def take(members, rows, scores):
        other = labels[members][:, None] != slot.labels[rows][None]
        floors = np.array([floor(m) for m in members], np.float64)
        some = (other & (scores >= floors[:, None])).any(axis=1)
        for i in np.flatnonzero(some).tolist():
            m = members[i]
            for (a, z), b in zip(ranges[m], best[m], strict=True):
                fits = other[i] & (scores[i] >= max(a, b.floor())) & (scores[i] <= z)
                if fits.any():
                    b.add(scores[i, fits], slot.ids[rows[fits]])
            floors[i] = floor(m)
        return floors

    SharedList(anchors, slot).walk(take)
    return best


# --- in Spark ---------------------------------------------------------------------------

PACKED = "dim int, ids binary, labels binary, vectors binary"


def quantised(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, q, dim) of the rows that take part; ``q`` is floor(scale * x) of each component."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    q = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    size = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return (rows.where(F.col(label_col).isNotNull() & v.isNotNull() & sound)
            .select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
            .select("id", "label", q.alias("q")).where(size < 2.0 ** 62).withColumn("dim", F.size("q")))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _pack_shards(batches):
    """Rows of (id, label, q, dim), packed by length of vector."""
    for b in batches:
        dims = b.column(3).to_numpy()
        for dim in np.unique(dims).tolist():
            own = b.filter(pa.array(dims == dim))
            out = []
            for lo in range(0, own.num_rows, SHARD):
                part = own.slice(lo, SHARD)
                out.append((dim, part.column(0).to_numpy().tobytes(), part.column(1).to_numpy().tobytes(),
                            _matrix(part.column(2), dim).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                             ["dim", "ids", "labels", "vectors"])


def _cluster(shared):
    """Each anchor's cluster and how near it is to the cluster's direction."""

    def run(batches):
        at = shared.value
        for b in batches:
            q, dims = b.column("q"), b.column("dim").to_numpy()
            cluster, near = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            own = np.flatnonzero(dims == at.shape[1]) if len(at) else np.zeros(0, int)
            if len(own):
                cos = unit(_matrix(q.take(pa.array(own)), at.shape[1])) @ at.T
                cluster[own], near[own] = cos.argmax(axis=1), cos.max(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cluster), pa.array(near)], [*b.schema.names, "cluster", "near"])

    return run


def _pack_blocks(batches):
    """Sorted anchors as blocks: runs of one length and cluster, ``BLOCK`` at most."""
    for b in batches:
        dims, cluster = b.column("dim").to_numpy(), b.column("cluster").to_numpy()
        cuts = np.flatnonzero(np.r_[True, (dims[1:] != dims[:-1]) | (cluster[1:] != cluster[:-1]), True])
        out = []
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            for lo in range(s, e, BLOCK):
                part = b.slice(lo, min(BLOCK, e - lo))
                out.append((int(dims[lo]), *[part.column(c).to_numpy().tobytes() for c in ("anchor", "label")],
                            _matrix(part.column("q"), int(dims[lo])).tobytes(), part.column("positives").to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.list_(pa.int64()))), strict=True)],
            ["dim", "ids", "labels", "vectors", "positives"])


def _slots(shards: pa.Table):
    """Candidates of each length of vector in a slot."""
    for dim in sorted(set(shards.column("dim").to_pylist())):
        own = shards.filter(pc.equal(shards.column("dim"), dim))
        ids, labels, flat = (np.frombuffer(b"".join(own.column(c).to_pylist()), np.int64) for c in ("ids", "labels", "vectors"))
        yield dim, Candidates(ids, labels, flat.reshape(len(ids), dim))


def _search(find, kind: str):
    """For each block of a group and the slot's candidates, what ``find`` gives as (anchor, part, scores, ids)."""

    def run(blocks: pa.Table, shards: pa.Table) -> pa.Table:
        found = []
        for dim, slot in _slots(shards) if blocks.num_rows else ():
            for b in blocks.to_pylist():
                if b["dim"] == dim:
                    keys, labels = np.frombuffer(b["ids"], np.int64), np.frombuffer(b["labels"], np.int64)
                    vectors = np.frombuffer(b["vectors"], np.int64).reshape(len(keys), dim)
                    found += [(int(keys[i]), part, best.scores.tolist(), best.ids.tolist())
                              for i, part, best in find(vectors, labels, b["positives"], slot) if len(best.ids)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 4, (
            pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)], ["anchor", "part", "scores", "ids"])

    def searched(blocks: DataFrame, shards: DataFrame, groups: int, slots: int) -> DataFrame:
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = (blocks.withColumn("g", F.pmod(F.xxhash64("ids", "vectors"), F.lit(groups)).cast("int"))
                .withColumn("s", every(slots)))
        right = (shards.withColumn("s", F.pmod(F.xxhash64("place"), F.lit(slots)).cast("int")).drop("place")
                 .withColumn("g", every(groups)))
        got = left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(run, kind)
        return got.select("anchor", "part", F.inline(F.arrays_zip(F.col("scores").alias("score"), F.col("ids").alias("id"))))

    return searched


FOUND = "anchor long, part int, scores array<long>, ids array<long>"


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each row that ``is_anchor`` and each of its first ``n_positives`` other rows of its label,
    the first ``n_negatives`` rows of other labels whose scores are ``low`` to ``high`` percent of
    the positive's.  ``is_anchor`` is an expression over the columns of ``rows``.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "negatives")
    marked = rows.select(F.col(id_col).alias("_i"), F.col(vector_col).alias("_v"), F.col(label_col).alias("_l"),
                         F.coalesce(is_anchor, F.lit(False)).alias("_a"))
    table = scratch.save(quantised(marked, "_i", "_v", "_l", scale))
    asked = quantised(marked.where(F.col("_a") & F.col("_i").isNotNull()), "_i", "_v", "_l", scale)
    # equal anchor rows have equal results: they are searched once, by a key of the row
    asked = (asked.groupBy("id", "label", "q", "dim").agg(F.count(F.lit(1)).alias("copies"))
             .withColumn("anchor", F.xxhash64("id", "label", "q"))
             .withColumn("own", F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x * x)))
    asked = scratch.save(asked)
    n, a = table.count(), asked.count()
    if not n or not a:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    sample = bounded_sample(asked.select("q", "dim", F.col("anchor").alias("o")), "o", SAMPLE).toArrow()
    dims = sample.column("dim").to_numpy()
    common = int(np.bincount(dims).argmax())
    fitted = _matrix(sample.filter(pa.array(dims == common)).column("q"), common)
    fitted = fitted[np.abs(fitted).sum(axis=1) > 0] if common else fitted[:0]
    at = centroids(fitted, max(1, min(CLUSTERS, math.isqrt(len(fitted))))) if len(fitted) else np.zeros((0, common))
    shared = spark.sparkContext.broadcast(at)
    kinds = ", ".join(f"{c} {t}" for c, t in asked.dtypes)
    asked = scratch.save(asked.mapInArrow(_cluster(shared), f"{kinds}, cluster int, near double"))

    tasks = 2 * spark.sparkContext.defaultParallelism
    shards = scratch.save(table.select("id", "label", "q", "dim").mapInArrow(_pack_shards, PACKED)
                          .withColumn("place", F.monotonically_increasing_id()))
    groups, slots = math.ceil(a / GROUP), max(math.ceil(n / SLOT), min(math.ceil(n / SHARD), tasks))

    def blocks(anchors: DataFrame) -> DataFrame:
        parts = max(1, min(tasks, math.ceil(a / BLOCK)), math.ceil(a / GROUP))
        packed = (anchors.select("dim", "cluster", "near", "anchor", "label", "q", "positives")
                  .repartitionByRange(parts, "dim", "cluster", F.desc("near"), "anchor").sortWithinPartitions("dim", "cluster", F.desc("near"), "anchor")
                  .mapInArrow(_pack_blocks, f"{PACKED}, positives array<array<long>>"))
        return scratch.save(packed)

    def own_label(vectors, labels, _, slot):
        return [(i, 0, b) for i, b in enumerate(first_of_label(vectors, labels, slot, n_positives + 1))]

    def in_bands(vectors, labels, positives, slot):
        got = first_in_bands(vectors, labels, [np.array(p, np.int64) for p in positives], slot, n_negatives, low, high)
        return [(i, j, b) for i, found in enumerate(got) for j, b in enumerate(found)]

    def first(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = _search(own_label, FOUND)(blocks(asked.withColumn("positives", F.lit(None).cast("array<long>"))), shards, groups, slots)
    listed = first(found, n_positives + 1).groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", F.col("id").alias("row")))).alias("listed"))
    joined = asked.join(listed, "anchor")
    itself = F.array_position(F.transform("listed", lambda x: (x["row"] == F.col("id")) & (x["score"] == F.col("own"))), True)
    others = F.slice(F.filter("listed", lambda x, i: i + 1 != F.col("itself")), 1, n_positives)
    joined = scratch.save(joined.withColumn("itself", itself).withColumn("others", others).where(F.size("others") > 0)
                          .withColumn("positives", F.transform("others", lambda x: x["score"])))
    found = _search(in_bands, FOUND)(blocks(joined), shards, groups, slots)
    known = joined.select("anchor", F.col("id").alias("anchor_id"), "copies", F.posexplode("others").alias("part", "positive"))
    known_id = lambda c: F.when(c != NO_ID, c)
    return (first(found, n_negatives).withColumnRenamed("id", "negative").join(known, ["anchor", "part"])
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("anchor_id", known_id(F.col("positive.row")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    known_id(F.col("negative")).alias("negative_id"), F.col("positive.score").alias("positive_score"),
                    F.col("score").alias("negative_score")))
