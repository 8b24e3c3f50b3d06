"""SimHash near-duplicates: a Gray-order hierarchical index over fingerprints.

1. Each text's fingerprint is made in an Arrow task; equal fingerprints collapse in a grouped
   minimum, so a group of exact copies of any size is one row from here on.
2. Two fingerprints that differ in at most ``d`` of their ``d + c`` bit blocks agree on ``c`` of
   them.  Each fingerprint goes to one bucket for each choice of ``c`` blocks; ``c`` only sets
   how fine the buckets are (it follows the count), never which links are found.
3. Buckets are range-partitioned by (choice, block bits, Gray rank), so a hot bucket spreads over
   tasks.  Each task builds a tree over its sorted rows: a node keeps the bits all its rows
   share (pattern and mask).  The tree is joined with itself from the roots: the differences
   of two nodes on bits both share only grow on the way down, so a pair of groups beyond ``d``
   is pruned whole; a pair whose worst case is within ``d`` is linked whole; groups already
   in one component are skipped.  A task emits one link a row at most.
4. Pieces of a bucket that several tasks hold meet in an equi-join, pruned by mask and pattern
   as well, and are joined tree against tree.
5. Links become components by star contraction, and documents get theirs by a join.

Defined cases: a null or empty text, or one of no words, has fingerprint zero; a text of fewer
words than a shingle is one shingle; rows repeat freely (each gets its fingerprint and
component); a null doc_id is never a component id, unless a component has none other (null);
a bit set in exactly half of the shingles is 0; a very long text is one task's, read whole;
only the id and text columns are read, so others may have any names.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, components, utf8, words

SEED = 42
FANOUT = 16
PAIRS_AT_ONCE = 1 << 20
PIECE = 8192
#: Rows of a bucket task, and rows that a bucket should hold on average.
TASK_ROWS = 400_000
BUCKET_ROWS = 4096


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles (XXH64, seed 42), as a signed integer."""
    ws = words(text, LOWER)
    if not ws:
        return 0
    line = b" ".join(ws)
    lens = np.fromiter(map(len, ws), np.int64, len(ws))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    if len(ws) > shingle:
        starts, ends = starts[:len(ws) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):  # bounded memory for very long texts
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[at:at + (1 << 16)].tolist(),
                                                              ends[at:at + (1 << 16)].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    value = int(np.packbits(total * 2 > len(starts), bitorder="little").view(np.uint64)[0])
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, row, fp): one row for each document row; ``row`` is a hash of its text."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], ["doc_id", "row", "fp"])

    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("row"),
                     utf8(docs, text_col))
    return df.mapInArrow(run, "doc_id long, row long, fp long")


# --- the tree ---------------------------------------------------------------------------

class Tree:
    """Levels of nodes over fingerprints sorted by (bucket, Gray rank).

    ``low[l]`` and ``varies[l]`` hold the nodes' shared pattern and the bits that are not shared;
    ``kids[l]`` the cut points of a node's children in level ``l - 1``; ``span[l]`` those of its rows.
    """

    def __init__(self, fps: np.ndarray, bucket: np.ndarray):
        self.fps = fps
        self.low, self.varies = [fps], [np.zeros_like(fps)]
        self.kids, self.span = [None], [np.arange(len(fps) + 1)]
        high, at = fps, bucket
        while True:
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            if len(first) == len(at) and len(self.low) > 1:
                break
            sizes = np.diff(np.r_[first, len(at)])
            within = np.arange(len(at)) - np.repeat(first, sizes)
            cut = np.flatnonzero(within % FANOUT == 0)
            low = np.bitwise_and.reduceat(self.low[-1], cut)
            high = np.bitwise_or.reduceat(high, cut)
            self.low.append(low)
            self.varies.append(low ^ high)
            self.kids.append(np.r_[cut, len(at)])
            self.span.append(self.span[-1][self.kids[-1]])
            at = at[cut]

    def links(self, d: int, roots: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """For each row the first row of its component under links of at most ``d`` bits."""
        n = len(self.fps)
        label = np.arange(n)
        top = len(self.low) - 1
        if roots is None:
            roots = (np.arange(len(self.low[top])),) * 2
        stack, found, waiting = [(top, *roots)], [], 0

        def merge():
            nonlocal label
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            while True:
                la, lb = label[a], label[b]
                open_ = la != lb
                if not open_.any():
                    break
                a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
                np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
                while not np.array_equal(nxt := label[label], label):
                    label = nxt
            found.clear()

        while stack:
            level, i, j = stack.pop()
            if len(i) > PAIRS_AT_ONCE:
                half = len(i) // 2
                stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
                continue
            free = self.varies[level][i] | self.varies[level][j]
            differ = np.bitwise_count((self.low[level][i] ^ self.low[level][j]) & ~free)
            keep = differ <= d
            whole = keep & (differ + np.bitwise_count(free) <= d)
            start = self.span[level]
            if whole.any():
                wi, wj = i[whole], j[whole]
                # a node joined with itself: its rows to its first row; two nodes: their first rows
                sizes = np.where(wi == wj, start[wi + 1] - start[wi], 1)
                a = np.repeat(start[wi], sizes)
                step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                b = np.repeat(np.where(wi == wj, start[wi], start[wj]), sizes) + step
                found.append((a, b))
                waiting += len(a)
                if waiting > max(n, 200_000):
                    merge()
                    waiting = 0
            more = keep & ~whole
            if level == 0 or not more.any():
                continue
            i, j = i[more], j[more]
            if not found:  # labels are fresh: skip groups that are one component already
                li, lj = label[start[i]], label[start[j]]
                if (li == lj).any():
                    lo = np.minimum.reduceat(label, start[:-1])
                    hi = np.maximum.reduceat(label, start[:-1])
                    open_ = (li != lj) | (lo[i] != hi[i]) | (lo[j] != hi[j])
                    i, j = i[open_], j[open_]
            kids = self.kids[level]
            ni, nj = kids[i + 1] - kids[i], kids[j + 1] - kids[j]
            size = ni * nj
            cuts = np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), PAIRS_AT_ONCE))
            for lo_, hi_ in zip(cuts, np.r_[cuts[1:], len(i)], strict=True):
                if lo_ == hi_:
                    continue
                s = size[lo_:hi_]
                step = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
                per = np.repeat(nj[lo_:hi_], s)
                ci = np.repeat(kids[i[lo_:hi_]], s) + step // per
                cj = np.repeat(kids[j[lo_:hi_]], s) + step % per
                once = (ci <= cj) | np.repeat(i[lo_:hi_] != j[lo_:hi_], s)
                stack.append((level - 1, ci[once], cj[once]))
        if found:
            merge()
        return label


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """The rank of each fingerprint in the reflected Gray code."""
    r = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _gray_rank(fp):
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp


def block_masks(d: int, agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` blocks out of ``d + agree``."""
    cuts = [64 * i // (d + agree) for i in range(d + agree + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


LINKS = "a long, b long, choice int, key long, part int, piece binary, low long, varies long"


def _join_tasks(d: int):
    """Links within each task's buckets, and the pieces of buckets at the task's edges."""

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        choice, key, fps = (np.concatenate([b.column(k).to_numpy() for b in got]) for k in range(3))
        fps = fps.view(np.uint64)
        bucket = np.cumsum(np.r_[0, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])])
        label = Tree(fps, bucket).links(d)
        own = np.flatnonzero(label != np.arange(len(fps)))
        signed = fps.view(np.int64)
        rows = {"a": signed[own].tolist(), "b": signed[label[own]].tolist()}
        pieces = []
        for at in {0, int(bucket[-1])}:
            rows_at = np.flatnonzero(bucket == at)
            for lo in range(rows_at[0], rows_at[-1] + 1, PIECE):
                x = fps[lo:min(lo + PIECE, rows_at[-1] + 1)]
                low, high = np.bitwise_and.reduce(x), np.bitwise_or.reduce(x)
                pieces.append((int(choice[lo]), int(key[lo]), x.tobytes(), int(low.view(np.int64)),
                               int((low ^ high).view(np.int64))))
        k, m = len(own), len(pieces)
        none = [None]
        yield pa.RecordBatch.from_arrays([
            pa.array(rows["a"] + none * m, pa.int64()), pa.array(rows["b"] + none * m, pa.int64()),
            pa.array(none * k + [p[0] for p in pieces], pa.int32()),
            pa.array(none * k + [p[1] for p in pieces], pa.int64()),
            pa.array([part] * (k + m), pa.int32()),
            pa.array(none * k + [p[2] for p in pieces], pa.binary()),
            pa.array(none * k + [p[3] for p in pieces], pa.int64()),
            pa.array(none * k + [p[4] for p in pieces], pa.int64())],
            ["a", "b", "choice", "key", "part", "piece", "low", "varies"])

    return run


def _join_pieces(d: int):
    """Links between two pieces of one bucket, tree against tree."""

    def run(batches):
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                fps = np.concatenate([x, y])
                tree = Tree(fps, np.repeat([0, 1], [len(x), len(y)]))
                label = tree.links(d, (np.array([0]), np.array([1])))
                own = np.flatnonzero(label != np.arange(len(fps)))
                signed = fps.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed[own]), pa.array(signed[label[own]])], ["a", "b"])

    return run


def links(scratch: Scratch, distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs within ``max_bits`` do."""
    n = distinct.count()
    agree = 1
    while agree < 4 and n / 2 ** (64 * agree / (max_bits + agree)) > BUCKET_ROWS:
        agree += 1
    masks = block_masks(max_bits, agree)
    fp = F.col("fp")
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(_signed(m))).alias("key"))
                        for i, m in enumerate(masks)])
    rows = (distinct.select("fp", F.explode(choices).alias("c"))
            .select("c.choice", "c.key", "fp", _gray_rank(fp).alias("gray")))
    tasks = max(1, math.ceil(n * len(masks) / TASK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    rows = (rows.repartitionByRange(tasks, "choice", "key", "gray")
            .sortWithinPartitions("choice", "key", "gray").select("choice", "key", "fp"))
    got = scratch.save(rows.mapInArrow(_join_tasks(max_bits), LINKS))
    piece = got.where("piece is not null").select("choice", "key", "part", "piece", "low", "varies")
    other = piece.toDF("choice", "key", "part2", "piece2", "low2", "varies2")
    shared = F.bitwise_not(F.col("varies").bitwiseOR(F.col("varies2")))
    pairs = (piece.join(other, ["choice", "key"]).where("part < part2")
             .where(F.bit_count(F.col("low").bitwiseXOR(F.col("low2")).bitwiseAND(shared)) <= max_bits)
             .select("piece", "piece2"))
    across = pairs.mapInArrow(_join_pieces(max_bits), "a long, b long")
    return got.where("a is not null").select("a", "b").union(across)


def groups(scratch: Scratch, docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, row, fp, group, component_id) for each row of ``docs``; ``group`` is a fingerprint."""
    fps = scratch.save(fingerprints(docs, shingle, id_col, text_col))
    distinct = scratch.save(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    root = components(scratch, links(scratch, distinct.select("fp"), max_bits))
    member = (distinct.join(root, distinct.fp == root.node, "left")
              .select("fp", "rep", F.coalesce("root", "fp").alias("group")))
    member = scratch.save(member)
    least = member.groupBy("group").agg(F.min("rep").alias("component_id"))
    return fps.join(member.join(least, "group").select("fp", "group", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Fingerprints that differ in at most ``max_bits`` bits are linked; ``component_id`` is the
    smallest doc_id reachable over links.
    """
    return groups(Scratch(docs.sparkSession, "simhash"), docs, shingle, max_bits, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (a null id is the largest)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    found = scratch.save(groups(scratch, docs, shingle, max_bits, id_col, text_col).select("doc_id", "row", "group"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("k")
    keep = scratch.save(found.groupBy("group").agg(first).select(F.col("k.doc_id").alias("_id"), F.col("k.row").alias("_row")))
    same = keep["_id"].eqNullSafe(docs[id_col].cast("long")) & (keep["_row"] == F.xxhash64(docs[text_col].cast("string")))
    kept = docs.join(keep, same, "left_semi")
    rows = found.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left_semi")
    again = rows.groupBy("doc_id", "row").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates([id_col, text_col]) if again else kept
