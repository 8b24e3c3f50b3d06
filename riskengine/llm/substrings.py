"""Substring dedup: prefix-partitioned suffix trees over the corpus's words.

A window is ``length`` consecutive words; it is a repeat where its words also start in a
document with a smaller id.  Suffixes whose first ``length`` words agree meet in one node of
string depth ``length`` of the corpus's suffix tree, so the repeats are that tree's deep nodes.

1. One pass over the texts makes, for each document, the digest of its words and its anchors:
   the least k-gram hash among the first ``length`` words of each suffix.  Suffixes that agree
   on them have one anchor, and neighbours mostly share it.
2. Documents with the same words are one from here on (the smallest id; every window of the
   others repeats).  Anchors of a single document are pruned: their suffixes can't meet any.
3. Suffixes are split into groups by anchor, a run of neighbouring suffixes travelling as one
   fragment of text; equal fragments collapse in a grouped minimum first.  A task takes many
   groups and builds their subtrees by prefix doubling: suffixes are split by their first 1,
   2, 4, ... words, exactly, word by word, down to ``length``; those alone in their branch end
   there.  Each node reached at that depth is a maximal repeat's and gives its least document.
4. A group beyond ``GROUP_SUFFIXES`` suffixes is split by a longer prefix, the whole ``length``
   words (told by a 128-bit hash): each of its nodes is then one key of a grouped minimum with
   map-side combine, and is joined back to its windows in rows of its own for each ``SPREAD`` of
   them, so that a common passage is dealt over tasks.
5. Fragments hand the repeats back to all their places by an equi-join, and the texts lose the
   covered words.

Defined cases: a null text has no words; texts shorter than a window keep everything; rows that
repeat (same id and text) get the same result each; a null id counts as the largest id; of windows
of one id none is smaller, so they stay; a text is read whole by one task, and its cost is linear;
columns beside id and text, whatever their names, are carried as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, Scratch, marked, mixed, utf8, word_hashes, words

GRAM = 10
#: Suffixes of one subtree group; beyond that its prefix is extended to the whole window.
GROUP_SUFFIXES = 200_000
#: Windows of one prefix that meet one row of its node, and the bound of the prefixes that have several.
SPREAD = 4096
HOT_PREFIXES = 50_000
#: Words that a task holds while it builds subtrees.
TREE_WORDS = 1_500_000
NO_ID = (1 << 63) - 1


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def _gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, by doubling."""
    part, have, out, done = h, 1, None, 0
    while True:
        if k & have:
            if out is None:
                out = part
            else:
                n = min(len(out), len(part) - done)
                out = mixed(out[:n] * MIX + part[done:done + n])
            done += have
        if have * 2 > k:
            return out
        part = mixed(part[:-have] * MIX + part[have:])
        have *= 2


def anchors(ws: list[bytes], length: int) -> np.ndarray:
    """For each window the least hash of its k-grams."""
    if len(ws) < length:
        return np.zeros(0, np.uint64)
    k = min(GRAM, length)
    return _sliding_min(_gram_hashes(mixed(word_hashes(ws)), k), length - k + 1)


def _scan(length: int):
    def run(batches):
        for b in batches:
            n, digest, own = [], [], []
            for t in b.column(2):
                ws = words(t.as_py())
                n.append(len(ws))
                digest.append(hashlib.sha256(b" ".join(ws)).digest())
                own.append(np.unique(anchors(ws, length)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(own, pa.list_(pa.int64()))], ["doc", "row", "n_words", "digest", "anchors"])

    return run


def _cut(length: int):
    """Fragments of a text: runs of windows with one shared anchor."""

    def run(batches):
        for b in batches:
            out = []
            for doc, row, t, shared in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3), strict=True):
                ws = words(t)
                a = anchors(ws, length).view(np.int64)
                first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                size = np.diff(np.r_[first, len(a)])
                keep = np.isin(a[first], np.array(shared.values))
                for s, n in zip(first[keep].tolist(), size[keep].tolist()):
                    text = b" ".join(ws[s:s + n + length - 1])
                    out.append((int(a[s]), xxhash.xxh128_digest(text), doc, row, s, n, text))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()),
                        strict=True)],
                    ["anchor", "piece", "doc", "row", "start", "n", "content"])

    return run


def _nodes_at_depth(ids: np.ndarray, frag: np.ndarray, several: np.ndarray,
                    length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of suffixes that may share their first ``length`` words with another document.

    Prefix doubling: the branch of a suffix at depth 2L is the pair of its branch at depth L
    and the one L words on; -1 marks suffixes that ended.  A suffix never crosses fragments.
    One alone in its branch ends, unless its fragment stands for ``several`` documents.
    """
    def alive(branch, at):
        _, branch, n = np.unique(branch, return_inverse=True, return_counts=True)
        return np.where((n[branch] > 1) | several[frag[at]], branch, -1)

    rank, depth = alive(ids, np.arange(len(ids))), 1
    while depth < length:
        step = min(depth, length - depth)
        a, b = rank[:max(0, len(rank) - step)], rank[step:]
        at = np.flatnonzero((a >= 0) & (b >= 0) & (frag[:len(a)] == frag[step:]))
        nxt = np.full(len(rank), -1, np.int64)
        nxt[at] = alive(a[at] * (int(rank.max(initial=0)) + 1) + b[at], at)
        rank, depth = nxt, depth + step
    at = np.flatnonzero(rank >= 0)
    return at, np.unique(rank[at], return_inverse=True)[1]


def _subtrees(length: int):
    """Runs of repeated windows in distinct fragments, with the least document of each."""

    def solve(rows):
        ids: dict[bytes, int] = {}
        number, sizes = [], []
        for r in rows:
            ws = r[4].split()
            sizes.append(len(ws))
            number += [ids.setdefault(w, len(ids)) for w in ws]
        frag = np.repeat(np.arange(len(rows)), sizes)
        begin = np.cumsum([0, *sizes[:-1]])
        least_doc = np.array([r[2] for r in rows])
        most_doc = np.array([r[3] for r in rows])
        at, node = _nodes_at_depth(np.array(number), frag, least_doc < most_doc, length)
        if not len(at):
            return None
        owner = frag[at]
        order = np.argsort(node, kind="stable")
        first = np.flatnonzero(np.r_[True, node[order][1:] != node[order][:-1]])
        per_node = np.minimum.reduceat(least_doc[owner][order], first)
        least = per_node[node]
        some = least < most_doc[owner]
        at, owner, least = at[some], owner[some], least[some]
        if not len(at):
            return None
        cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])])
        n = np.diff(np.r_[cut, len(at)])
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in owner[cut]], pa.int64()),
             pa.array([rows[i][1] for i in owner[cut]], pa.binary()),
             pa.array(at[cut] - begin[owner[cut]], pa.int32()), pa.array(n, pa.int32()),
             pa.array(least[cut], pa.int64())], ["anchor", "piece", "off", "cnt", "least"])

    def run(batches):
        rows, held, last = [], 0, None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held >= TREE_WORDS and r[0] != last:  # groups stay whole
                    if (out := solve(rows)) is not None:
                        yield out
                    rows, held = [], 0
                rows.append(r)
                held += len(r[4]) // 6
                last = r[0]
        if rows and (out := solve(rows)) is not None:
            yield out

    return run


def _split(length: int):
    """Each window of a fragment by its whole prefix."""

    def run(batches):
        for b in batches:
            for anchor, piece, least, most, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ws = text.split()
                n = len(ws) - length + 1
                keys = [xxhash.xxh128_digest(b" ".join(ws[i:i + length])) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * n, pa.int64()), pa.array([piece] * n, pa.binary()),
                     pa.array(range(n), pa.int32()), pa.array(keys, pa.binary()),
                     pa.array([least] * n, pa.int64()), pa.array([most] * n, pa.int64())],
                    ["anchor", "piece", "off", "prefix", "first_doc", "last_doc"])

    return run


def _with_least(scratch: Scratch, windows: DataFrame) -> DataFrame:
    """Each window with the smallest document of its prefix's node (``least``).

    The node of a prefix of more than ``SPREAD`` windows is repeated, a row for each ``SPREAD`` of them,
    and its windows are dealt to these rows by their fragment.  Only prefixes of more than a
    ``HOT_PREFIXES``-th of all windows need it, fewer than ``HOT_PREFIXES``: the bound of the broadcasts.
    """
    node = scratch.save(windows.groupBy("prefix").agg(F.min("first_doc").alias("least"), F.count(F.lit(1)).alias("n")))
    total = node.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(scratch.save(node.where(F.col("n") > F.lit(max(float(SPREAD), total / HOT_PREFIXES)))
                                   .select("prefix", F.ceil(F.col("n") / SPREAD).cast("long").alias("rows"))))
    rows = F.coalesce(F.col("rows"), F.lit(1).cast("long"))
    dealt = windows.join(hot, "prefix", "left").withColumn("row", F.pmod(F.xxhash64("piece", "off"), rows)).drop("rows")
    nodes = (node.join(hot, "prefix", "left")
             .select("prefix", "least", F.explode(F.sequence(F.lit(0).cast("long"), rows - 1)).alias("row")))
    return dealt.join(nodes, ["prefix", "row"]).drop("row")


def repeated_windows(scratch: Scratch, docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The scan of all rows, and the repeats as (doc, row, places): runs of ``cnt`` windows at ``start``.

    Rows that share all their words with a smaller id are left out of the repeats; they are
    marked in the scan (``first_doc < doc``).
    """
    src = _keyed(docs, id_col, text_col)
    scan = scratch.save(src.mapInArrow(
        _scan(length), "doc long, row long, n_words long, digest binary, anchors array<long>"))
    first = scan.groupBy("digest").agg(F.min("doc").alias("first_doc"))
    scan_first = scan.join(first, "digest")
    own = (scan_first.where((F.col("doc") == F.col("first_doc")) & (F.col("n_words") >= length))
           .select("doc", "row", F.explode("anchors").alias("anchor")).distinct())
    own = scratch.save(own)
    shared = (own.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
              .where("lo < hi").select("anchor"))
    lists = scratch.save(own.join(shared, "anchor").groupBy("doc", "row")
                         .agg(F.collect_list("anchor").alias("shared")))
    scratch.drop(own)
    pieces = scratch.save(
        marked(src, ["doc", "row"], lists).where("_maybe").join(lists, ["doc", "row"]).select("doc", "row", text_col, "shared")
        .mapInArrow(_cut(length), "anchor long, piece binary, doc long, row long, start int, n int, content binary"))
    distinct = pieces.groupBy("anchor", "piece").agg(
        F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"), F.max("n").alias("n"),
        F.min("content").alias("content"))
    distinct = scratch.save(distinct)
    large = (distinct.groupBy("anchor").agg(F.sum("n").alias("suffixes"))
             .where(F.col("suffixes") > GROUP_SUFFIXES).select("anchor"))
    large = scratch.save(large)
    cols = ["anchor", "piece", "first_doc", "last_doc", "content"]
    runs = "anchor long, piece binary, off int, cnt int, least long"
    small = (distinct.join(large, "anchor", "left_anti").select(cols)
             .repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_subtrees(length), runs))
    windows = distinct.join(large, "anchor", "left_semi").select(cols).mapInArrow(
        _split(length), "anchor long, piece binary, off int, prefix binary, first_doc long, last_doc long")
    deep = (_with_least(scratch, windows).where("least < last_doc")
            .select("anchor", "piece", "off", F.lit(1).alias("cnt"), "least"))
    # one row a fragment, so that its places meet one row each
    runs = scratch.save(small.unionByName(deep).groupBy("anchor", "piece").agg(
        F.sort_array(F.collect_list(F.struct("off", "cnt", "least"))).alias("runs")))
    scratch.drop(distinct, lists)
    own = F.filter("runs", lambda r: r.least < F.col("doc"))
    repeats = (pieces.drop("content").join(runs, ["anchor", "piece"])
               .select("doc", "row", F.transform(own, lambda r: F.struct(
                   (F.col("start") + r.off).alias("start"), r.cnt.alias("cnt"))).alias("places"))
               .where(F.size("places") > 0))
    return scan_first, repeats


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, text): a null id is the largest; rows of one id differ by their text's hash."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("row"), utf8(docs, text_col))


def _kept_words(text: bytes | None, spans: list[dict], length: int) -> tuple[list[bytes], int]:
    """Words outside every span of repeated windows, and how many are inside."""
    ws = words(text)
    edge = np.zeros(len(ws) + 1, np.int64)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["start"] + s["cnt"] + length - 1] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(ws, gone.tolist(), strict=True) if not g], int(gone.sum())


def _kept(length: int):
    def run(batches):
        for b in batches:
            removed, digest = [], []
            for t, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                kept, n = _kept_words(t, spans, length)
                removed.append(n)
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                ["doc", "row", "n_removed", "kept_sha256"])

    return run


def _spans(repeats: DataFrame) -> DataFrame:
    return repeats.groupBy("doc", "row").agg(F.flatten(F.collect_list("places")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "substrings")
    scan, repeats = repeated_windows(scratch, docs, length, id_col, text_col)
    kept = scratch.save(_keyed(docs, id_col, text_col).join(_spans(repeats), ["doc", "row"])
                        .select("doc", "row", text_col, "spans")
                        .mapInArrow(_kept(length), "doc long, row long, n_removed long, kept_sha256 string"))
    copy = (F.col("first_doc") < F.col("doc")) & (F.col("n_words") >= length)
    return (scan.drop("anchors").join(kept.dropDuplicates(["doc", "row"]), ["doc", "row"], "left").select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256")))


def cleaned_texts(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with each text less its repeated words.

    A text that loses nothing stays as it is, spacing included; one that loses words is its
    kept words joined by one space; one that loses all is the empty text.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    scan, repeats = repeated_windows(scratch, docs, length, id_col, text_col)
    copies = (scan.where((F.col("first_doc") < F.col("doc")) & (F.col("n_words") >= length))
              .select("doc", "row", F.array(F.struct(
                  F.lit(0).alias("start"), (F.col("n_words") - length + 1).cast("int").alias("cnt"))).alias("places")))
    spans = scratch.save(_spans(repeats.unionByName(copies)))
    scratch.drop(*scratch.saved[:-1])

    @F.arrow_udf("string")
    def strip(text: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([None if s is None else b" ".join(_kept_words(t, s, length)[0]).decode()
                         for t, s in zip(text.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    # the row travels as one struct, so that none of its columns can clash with ours
    rows = marked(docs.select(F.struct("*").alias("d"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                              F.xxhash64(F.col(text_col).cast("string")).alias("row")), ["doc", "row"], spans)
    text = F.col(f"d.`{text_col}`").cast("string")
    stripped = F.coalesce(strip(F.when(F.col("spans").isNotNull(), text.cast("binary")), F.col("spans")), text)

    def with_text(rows: DataFrame, new) -> DataFrame:
        return rows.select(*[new.alias(c) if c == text_col else F.col(f"d.`{c}`").alias(c) for c in docs.columns])

    return (with_text(rows.where("_maybe").join(spans, ["doc", "row"], "left"), stripped)
            .union(with_text(rows.where(~F.col("_maybe")), text)))  # texts that lose nothing aren't moved
