"""Toxicity scores by a convolutional text classifier, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first bytes, so unseen
forms of a known stem are near it.  Filters of several widths slide over the whole text, each
keeps its largest response, and a logistic layer joins them.  Max pooling makes the cost of a
text linear and its gradient sparse: only the words that won move.

Training uses every labelled row.  They are dealt by the hash of text and id into chunks of
``CHUNK_ROWS`` rows or ``CHUNK_BYTES`` bytes, about, encoded once and written.  In a round every
chunk takes ``PASSES`` of the ``EPOCHS`` over its rows from the common parameters, and a grouped mean of
the parameters that the chunks moved is the next round's start: an embedding row counts the chunks
that moved it, all else every chunk.  One chunk alone is plain training.  The driver holds the
network, never the rows: features share embedding rows where there are more than ``MOST`` of them.
A quarter of each chunk is kept out to calibrate.

Thresholds are calibrated by language, the language being told from the text by :mod:`.langid`,
learned on the same rows: the score is the network's probability shifted so that the language's own
threshold lands on ``CUT``.  Labels, lang, source and id of a scored row never enter.

Defined cases: a null or empty text is scored as a text of no words; a null label, one other than 0
and 1, or one whose text is null, is not learned from; without both classes every score is the base
rate (0 if nothing is labelled); equal labels of one document count once, unequal ones each, and
repeated documents each; a text is learned from whole, in one task, at linear cost;
repeated rows are scored each; a score that equals the threshold is toxic; a column named as the
result (``into``) is replaced, others are carried whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import langid
from .common import ALNUM, Scratch, Shared, utf8, words

CHUNK_ROWS, CHUNK_BYTES = 6000, 1 << 25
PASSES = 3             # of a chunk in a round
PREFIXES = (4, 6)      # bytes; the whole word comes first
HASH_BITS = 24
MOST = 1 << 21         # known features that have embedding rows of their own
MIN_DOCS = 2           # a hashed feature of fewer labelled texts keeps the zero vector
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.02, 1e-4
CUT = 0.7
SHRINK = 50            # calibration positives at which a language's own threshold counts half
PAD = max(WIDTHS)
SLICE = 1 << 21        # bytes of texts that are scored together


def features(word: bytes) -> tuple[int, ...]:
    """Hashed features of a word: the whole and its prefixes."""
    mask = (1 << HASH_BITS) - 1
    return (xxhash.xxh32_intdigest(word) & mask,
            *[xxhash.xxh32_intdigest(word[:n], n) & mask for n in PREFIXES])


class Network:
    """Embedding rows of known features, filters, the logistic layer and language thresholds."""

    def __init__(self, known: list[int] | np.ndarray, shift: int = 0, seed: int = 4):
        rng = np.random.default_rng(seed)
        self.shift = shift                        # bits that features lose
        self.known = np.asarray(known, np.int32)  # ascending
        self.embed = np.zeros((len(known) + 1, DIM), np.float32)  # row 0: unknown
        self.filters = [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = rng.normal(0, 0.5, len(WIDTHS) * FILTERS).astype(np.float32)
        self.base = np.float32(0)
        self.cuts: dict[str | None, float] = {None: 0.0}
        self.constant: float | None = None
        # what training adds: Adagrad's sums, Adam's moments and steps
        self.seen: np.ndarray | None = None
        self.first, self.second = ([np.zeros_like(p) for p in self.params] for _ in range(2))
        self.step = 0

    def rows(self, ids: np.ndarray) -> np.ndarray:
        """Embedding rows of hashed features."""
        if not len(self.known):
            return np.zeros(ids.shape, np.int64)
        ids = ids >> self.shift
        at = np.searchsorted(self.known, ids)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == ids, at + 1, 0)

    def pooled(self, x: np.ndarray, starts: np.ndarray):
        """Largest response of each filter within each text, and where it was."""
        ends = np.r_[starts[1:], len(x)]
        best = np.empty((len(starts), len(WIDTHS) * FILTERS), np.float32)
        at = np.empty(best.shape, np.int64)
        for k, w in enumerate(WIDTHS):
            z = np.zeros((len(x), FILTERS), np.float32)
            for o in range(w):
                z[:len(x) - o] += x[o:] @ self.filters[k][o]
            for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
                own = z[s:e - PAD + 1]  # texts end in PAD zero vectors
                j = own.argmax(axis=0)
                at[i, k * FILTERS:(k + 1) * FILTERS] = s + j
                best[i, k * FILTERS:(k + 1) * FILTERS] = own[j, np.arange(FILTERS)] + self.bias[k]
        return best, at

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return sum(self.embed.take(c, axis=0) for c in rows.T) if len(rows) else np.zeros((0, DIM), np.float32)

    def logit(self, rows: np.ndarray) -> float:
        return self.response(self.vectors(rows))

    def response(self, vectors: np.ndarray) -> float:
        """The logit of a text given as its words' vectors."""
        x, best = np.concatenate([vectors, np.zeros((PAD, DIM), np.float32)]), []
        for f in self.filters:  # as in ``pooled``, without the places
            z = x @ f[0]
            for o in range(1, len(f)):
                z[:-o] += x[o:] @ f[o]
            best.append(z[:len(vectors) + 1].max(axis=0))
        return float(np.maximum(np.concatenate(best) + self.bias.ravel(), 0) @ self.out + self.base)

    def start(self, seed: int = 5) -> np.random.Generator:
        """Random embeddings and fresh optimisers; the generator goes on to shuffle texts."""
        rng = np.random.default_rng(seed)
        self.embed[1:] = rng.normal(0, 0.05, (len(self.embed) - 1, DIM))
        self.seen = np.full(self.embed.shape, 1e-2, np.float32)
        return rng

    @property
    def params(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.out]

    @property
    def dense(self) -> np.ndarray:
        """Filters, biases, the logistic layer and their optimiser's moments, as one array."""
        return np.concatenate([*(x.ravel() for x in (*self.params, *self.first, *self.second)), [self.base]])

    @dense.setter
    def dense(self, values: np.ndarray) -> None:
        at = 0
        for x in (*self.params, *self.first, *self.second):
            x[:] = values[at:at + x.size].reshape(x.shape)
            at += x.size
        self.base = np.float32(values[at])

    def train(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> None:
        """All epochs over texts of one process."""
        rng = self.start(seed)
        weight = class_weights(labels, labels.sum(), (1 - labels).sum())
        for _ in range(EPOCHS):
            self.epoch(texts, labels, weight, rng.permutation(len(texts)))

    def epoch(self, texts: list[np.ndarray] | Chunk, labels: np.ndarray, weight: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Adam on filters and the logistic layer, Adagrad on the embedding rows that won; tells which these are."""
        moved = np.zeros(len(self.embed), bool)
        params, first, second, seen = self.params, self.first, self.second, self.seen
        gap = np.zeros((PAD, len(PREFIXES) + 1), np.int64)
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            rows = np.concatenate([r for i in some for r in (texts[i], gap)])
            starts = np.cumsum([0, *[len(texts[i]) + PAD for i in some[:-1]]])
            x = self.vectors(rows)
            best, at = self.pooled(x, starts)
            live = np.maximum(best, 0)
            p = 1 / (1 + np.exp(-(live @ self.out + self.base)))
            d = ((p - labels[some]) * weight[some] / len(some)).astype(np.float32)
            dbest = np.outer(d, self.out).astype(np.float32) * (best > 0)
            grads = [np.zeros_like(f) for f in self.filters] + [dbest.sum(axis=0).reshape(self.bias.shape), live.T @ d]
            dx, where = [], []
            for k, w in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                for o in range(w):
                    t = at[:, cols] + o
                    grads[k][o] = np.einsum("nf,nfd->df", dbest[:, cols], x[t])
                    dx.append((dbest[:, cols, None] * self.filters[k][o].T[None]).reshape(-1, DIM))
                    where.append(t.ravel())
            dx, where = np.concatenate(dx), rows[np.concatenate(where)]
            touched, inverse = np.unique(where, return_inverse=True)
            g = np.zeros((len(touched), DIM), np.float32)
            for c in range(where.shape[1]):
                np.add.at(g, inverse.reshape(where.shape)[:, c], dx)
            g[touched == 0] = 0
            seen[touched] += g * g
            self.embed[touched] -= RATE * 5 * g / np.sqrt(seen[touched])
            moved[touched[g.any(axis=1)]] = True
            self.step += 1
            for q, grad, m, v in zip(params, grads, first, second, strict=True):
                grad = grad + DECAY * q
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                q -= RATE * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
            self.base -= np.float32(RATE * d.sum())
        self.embed[1:] *= 1 - DECAY
        return moved

    def part(self, rows: np.ndarray) -> Network:
        """A copy with some embedding rows alone (ascending, 0 first)."""
        net = Network([])
        net.embed, net.seen = self.embed[rows], None if self.seen is None else self.seen[rows]
        net.dense, net.step = self.dense, self.step
        return net

    def calibrate(self, cuts: dict[str | None, tuple[float, int, int]]) -> None:
        """Takes :func:`best_cuts`; a language's own cut is drawn to the common one as its positives are few."""
        common = cuts[None][0]
        self.cuts = {None: common}
        for x, (cut, n, clean) in cuts.items():
            if x is not None and n and clean:
                self.cuts[x] = (n * cut + SHRINK * common) / (n + SHRINK)

    def score(self, vectors: np.ndarray, language: str) -> float:
        if self.constant is not None:
            return self.constant
        shifted = self.response(vectors) - self.cuts.get(language, self.cuts[None]) + np.log(CUT / (1 - CUT))
        return float(1 / (1 + np.exp(-np.clip(shifted, -500, 500))))


def class_weights(labels: np.ndarray, positives: float, negatives: float) -> np.ndarray:
    """Weights by which both classes, of so many rows in all, weigh the same."""
    weight = np.where(labels == 1, np.float32(0.5) / np.float32(max(1, positives)), np.float32(0.5) / np.float32(max(1, negatives)))
    return weight * np.float32(positives + negatives)


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The cut that errs least (the middle of the best range), of rows in one process."""
    order = np.argsort(logits, kind="stable")
    v, y = logits[order], labels[order]
    edges = np.r_[v[0] - 2, (v[1:] + v[:-1]) / 2, v[-1] + 2]
    # a false alarm costs as much as a miss, class by class
    missed = np.r_[0, np.cumsum(y)] / max(1, y.sum())
    alarms = 1 - np.r_[0, np.cumsum(1 - y)] / max(1, (1 - y).sum())
    good = np.flatnonzero(missed + alarms <= (missed + alarms).min() + 1e-12)
    return float((edges[good[0]] + edges[good[-1]]) / 2)


def best_cuts(scratch: Scratch, logits: DataFrame) -> dict[str | None, tuple[float, int, int]]:
    """``best_cut`` of all rows (lang, v, y), by None, and of each language's, with its positives and negatives.

    Logits are sorted by range; running counts of a range go on from the totals of those before.
    Costs are whole numbers, and equal logits are never parted.
    """
    groups = logits.select(F.explode(F.array(F.lit(None).cast("string"), F.col("lang"))).alias("lang"), "v", "y")
    counts = groups.groupBy("lang", "v").agg(F.sum("y").cast("long").alias("pos"), F.sum(1 - F.col("y")).cast("long").alias("neg"))
    ranges = scratch.save(counts.repartitionByRange("lang", "v").withColumn("part", F.spark_partition_id()))
    totals: dict[str | None, list] = {}
    for r in ranges.groupBy("lang", "part").agg(F.min("v").alias("v"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect():
        totals.setdefault(r.lang, []).append((r.v, r.part, r.pos, r.neg))
    before, all_of = [], {}
    for lang, parts in totals.items():
        parts.sort()
        all_of[lang] = n_pos, n_neg = sum(p[2] for p in parts), sum(p[3] for p in parts)
        p = n = 0
        for (_, part, pos, neg), after in zip(parts, [*parts[1:], (None,)], strict=True):
            before.append((lang, part, p, n, n_pos, n_neg, after[0]))
            p, n = p + pos, n + neg
    known = scratch.spark.createDataFrame(before, "b_lang string, b_part int, p long, n long, n_pos long, n_neg long, after double")
    order = Window.partitionBy("lang", "part").orderBy("v")
    v, up_to = F.col("v"), order.rowsBetween(Window.unboundedPreceding, 0)
    # cost: misses and false alarms, each as shares of its class, times both classes' rows
    edges = (ranges.join(F.broadcast(known), F.col("lang").eqNullSafe(F.col("b_lang")) & (F.col("part") == F.col("b_part")))
             .select("lang", ((F.col("p") + F.sum("pos").over(up_to)) * F.greatest("n_neg", F.lit(1))
                              + (F.col("n_neg") - F.col("n") - F.sum("neg").over(up_to)) * F.greatest("n_pos", F.lit(1))).alias("cost"),
                     ((F.coalesce(F.lead("v").over(order), F.col("after"), v + 4) + v) / 2).alias("edge")))
    out = {}
    for r in edges.groupBy("lang").agg(F.min(F.struct("cost", "edge")).alias("low"),
                                       F.min(F.struct("cost", (-F.col("edge")).alias("edge"))).alias("high")).collect():
        n_pos, n_neg = all_of[r.lang]
        low, high, lowest = r.low.edge, -r.high.edge, min(totals[r.lang])[0] - 2
        cost = n_neg * max(1, n_pos)  # of the cut below all logits: every row is told toxic
        if cost <= r.low.cost:
            low, high = lowest, high if cost == r.low.cost else lowest
        out[r.lang] = (low + high) / 2, n_pos, n_neg
    return out


def xxh32(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """``xxhash.xxh32_intdigest`` of many short runs of bytes; those of 16 and more are hashed one by one."""
    p1, p2, p3, p4, p5 = (np.uint32(p) for p in (2654435761, 2246822519, 3266489917, 668265263, 374761393))
    turned = lambda h, n: (h << np.uint32(n)) | (h >> np.uint32(32 - n))
    data = np.concatenate([data, np.zeros(16, np.uint8)])
    lanes = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))
    h = size.astype(np.uint32) + np.uint32((seed + int(p5)) & 0xFFFFFFFF)
    at = start.copy()
    for k in range(3):
        some = np.flatnonzero(size >= 4 * k + 4)
        h[some] = turned(h[some] + lanes[at[some]] * p3, 17) * p4
        at[some] += 4
    for k in range(3):
        some = np.flatnonzero(size % 4 > k)
        h[some] = turned(h[some] + data[np.minimum(at[some] + k, len(data) - 1)] * p5, 11) * p1
    h = (h ^ (h >> np.uint32(15))) * p2
    h = (h ^ (h >> np.uint32(13))) * p3
    h ^= h >> np.uint32(16)
    for i in np.flatnonzero(size >= 16).tolist():
        h[i] = xxhash.xxh32_intdigest(data[start[i]:start[i] + size[i]].tobytes(), seed)
    return h


def all_features(distinct: pa.LargeBinaryArray) -> np.ndarray:
    """``features`` of each word, a row a word."""
    ends, data = (np.frombuffer(b, kind) for b, kind in zip(distinct.buffers()[1:], (np.int64, np.uint8), strict=True))
    start, size = ends[:len(distinct)], np.diff(ends[:len(distinct) + 1])
    hashes = [xxh32(data, start, size), *[xxh32(data, start, np.minimum(size, n), n) for n in PREFIXES]]
    return (np.stack(hashes, axis=1) & np.uint32((1 << HASH_BITS) - 1)).astype(np.int32)


def numbered(texts: list[bytes | None]) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """Distinct words of texts, all words as numbers of these, and how many words there are up to each text's end."""
    joined = np.frombuffer(b" ".join([b"", *(t or b"" for t in texts), b""]).translate(ALNUM), np.uint8)
    inside = joined != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, stop = edges[::2], edges[1::2]
    ends = np.searchsorted(start, np.cumsum([len(t or b"") + 1 for t in texts]))
    offsets = np.cumsum(np.r_[0, stop - start]).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(joined[inside])]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), ends


def word_vectors(net: Network, texts: list[bytes | None]) -> Iterable[np.ndarray]:
    """Word vectors of each text; the distinct words of ``SLICE`` bytes of texts are looked up together."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and size < SLICE:
            size += len(texts[hi] or b"") + 1
            hi += 1
        distinct, at, ends = numbered(texts[lo:hi])
        held = net.vectors(net.rows(all_features(distinct)))
        yield from (held.take(x, axis=0) for x in np.split(at, ends[:-1]))
        lo = hi


class Chunk:
    """A chunk's texts as numbers of its distinct words, their labels, and which are kept out."""

    SCHEMA = "words binary, at binary, ends binary, y binary, out binary, langs array<string>, fit_pos long, fit_neg long, out_pos long, out_neg long"

    @staticmethod
    def row(texts: Iterable[bytes], y: np.ndarray, out: np.ndarray, langs: list[str | None]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        at, ends = [], []
        for t in texts:
            ws = words(t, ALNUM)
            at.append(np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int32, len(ws)))
            ends.append(len(ws))
        width = len(PREFIXES) + 1
        ids = np.fromiter((f for w in number for f in features(w)), np.int32, width * len(number))
        counts = [int((side & (y == label)).sum()) for side in (~out, out) for label in (1, 0)]
        cells = [ids.tobytes(), b"".join(x.tobytes() for x in at), np.cumsum(ends).astype(np.int64).tobytes(),
                 y.astype(np.int8).tobytes(), out.astype(bool).tobytes(), langs, *counts]
        kinds = [pa.binary()] * 5 + [pa.list_(pa.string())] + [pa.int64()] * 4
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)],
                                          [c.split()[0] for c in Chunk.SCHEMA.split(", ")])

    def __init__(self, cells: list[pa.Scalar]):
        words, at, ends, y, out = ((np.frombuffer(c.as_buffer(), kind) if c.as_buffer().size else np.zeros(0, kind))
                                   for c, kind in zip(cells, (np.int32, np.int32, np.int64, np.int8, bool), strict=False))
        self.ids, self.at = words.reshape(-1, len(PREFIXES) + 1), np.split(at, ends[:-1])
        self.y, self.out, self.langs = y, out, cells[5].as_py()

    def opened(self, net: Network) -> tuple[Network, np.ndarray]:
        """The network with the chunk's own embedding rows, and their places; texts are in terms of these."""
        rows = net.rows(self.ids)
        used = np.unique(np.r_[0, rows.ravel()])
        self.rows = np.searchsorted(used, rows)
        return net.part(used), used

    def __getitem__(self, i: int) -> np.ndarray:
        return self.rows[self.at[i]]


def chunks_of(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield Chunk([c[i] for c in b.columns])


def encoded(scratch: Scratch, texts: DataFrame, marks: DataFrame, chunks: int, language: Shared, keep_out: bool) -> DataFrame:
    """A written row for each chunk; a language is told for the rows that calibrate.

    Texts (id, o, text) travel once, each to its chunk, where the marks (id, o, y) meet them.
    """

    def pack(rows: pa.Table):
        told, held, key = [], [], None  # a document's texts come before its marks
        for i, (o, d, y) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("o", "id", "y")), strict=True)):
            if key != (o, d):
                held, key = [], (o, d)
            if y is None:
                held.append(i)
            else:
                told += [(j, y) for j in held]
        if not told:
            return
        text, y = rows.column("text"), np.array([t[1] for t in told])
        out = (np.arange(len(y)) % 4 == 3) & keep_out
        langs = [language.value.predict(text[j].as_py())[0] if k or not keep_out else None
                 for (j, _), k in zip(told, out.tolist(), strict=True)]
        yield Chunk.row((text[j].as_py() for j, _ in told), y, out, langs)

    def packed(batches):  # a partition is a chunk
        first = next(batches, None)
        if first is not None:
            yield from pack(pa.Table.from_batches([first, *batches]))

    both = texts.withColumn("y", F.lit(None).cast("int")).unionByName(marks.withColumn("text", F.lit(None).cast("binary")))
    dealt = both.repartitionById(chunks, F.pmod("o", F.lit(chunks)).cast("int"))
    return scratch.save(dealt.sortWithinPartitions("o", "id", F.col("y").asc_nulls_first()).mapInArrow(packed, Chunk.SCHEMA))


def known_features(scratch: Scratch, packed: DataFrame) -> tuple[np.ndarray, int]:
    """Hashed features of ``MIN_DOCS`` texts, ascending, and the bits they lose to be ``MOST`` at most."""

    def count(batches):
        for c in chunks_of(batches):
            feature, n = np.unique(np.concatenate([np.unique(c.ids[x]) for x in c.at]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(feature, pa.int32()), pa.array(n, pa.int64())], ["feature", "n"])

    counts = packed.mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    known = scratch.save(counts.where(F.col("n") >= MIN_DOCS).select("feature"))
    shift = 0 if known.count() <= MOST else HASH_BITS - MOST.bit_length() + 1
    got = known.select(F.shiftright("feature", shift).alias("feature")).distinct().toArrow()  # MOST at most
    scratch.drop(known)
    return np.sort(got.column(0).to_numpy()), shift


@contextmanager
def options(spark: SparkSession, values: dict[str, str]):
    """Session options for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


VALUES = [f"v{i}" for i in range(2 * DIM)]


def fit(packed: DataFrame, net: Network, chunks: int, positives: int, negatives: int) -> None:
    """Rounds of a pass over every chunk, each from the mean of the parameters that the last one moved."""
    rng, spark = net.start(), packed.sparkSession
    state, size, together = rng.bit_generator.state, len(net.dense), EPOCHS if chunks == 1 else PASSES
    for done in range(0, EPOCHS, together):
        shared = Shared(spark, net)

        def run(batches, done=done, shared=shared):
            for c in chunks_of(batches):
                own, used = c.opened(shared.value)
                some, y = np.flatnonzero(~c.out), c.y.astype(np.float32)
                bits = np.random.PCG64()
                bits.state = state
                rng = np.random.Generator(bits)
                weight, moved = class_weights(y, positives, negatives), np.zeros(len(used), bool)
                for _ in range(done):
                    rng.permutation(len(some))
                for _ in range(together):
                    moved |= own.epoch(c, y, weight, some[rng.permutation(len(some))])
                # dense values follow in rows of their own, numbered below 0
                dense = np.zeros((-(-size // (2 * DIM)), 2 * DIM))
                dense.ravel()[:size] = own.dense
                values = np.r_[np.c_[own.embed, own.seen][moved], dense].astype(np.float32)
                rows = np.r_[used[moved], -1 - np.arange(len(dense))]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(np.full(len(rows), own.step), pa.int64()),
                                                  *[pa.array(np.ascontiguousarray(x)) for x in values.T]], ["row", "step", *VALUES])

        # sums of float32 in double don't depend on their order, unless exponents are 20 bits and more apart
        moved = packed.mapInArrow(run, f"row int, step long, {', '.join(f'{x} float' for x in VALUES)}").groupBy("row").agg(
            F.max("step").alias("step"), F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in VALUES]).select(
            "row", "step", *[(F.col(x) / F.col("n")).cast("float").alias(x) for x in VALUES]).toArrow()  # the network's rows at most
        shared.destroy()
        row, values = moved.column("row").to_numpy(), np.stack([moved.column(x).to_numpy() for x in VALUES], axis=1)
        for _ in range(together):
            net.embed[1:] *= 1 - DECAY
        net.embed[row[row > 0]], net.seen[row[row > 0]] = values[row > 0, :DIM], values[row > 0, DIM:]
        net.dense = values[row < 0][np.argsort(-row[row < 0])].ravel()[:size]
        net.step = max(moved.column("step").to_pylist())


def logits(packed: DataFrame, net: Network, keep_out: bool) -> DataFrame:
    """(lang, v, y) of the rows that calibrate."""
    shared = Shared(packed.sparkSession, net)

    def run(batches):
        for c in chunks_of(batches):
            own, _ = c.opened(shared.value)
            some = np.flatnonzero(c.out | (not keep_out)).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([c.langs[i] for i in some], pa.string()), pa.array([own.logit(c[i]) for i in some], pa.float64()),
                                              pa.array([int(c.y[i]) for i in some], pa.int64())], ["lang", "v", "y"])

    return packed.mapInArrow(run, "lang string, v double, y long")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[Network, langid.Model]:
    """Fit the network and the language model on all labelled rows of ``docs``."""
    language = langid.learn(docs, text_col)
    with options(docs.sparkSession, {
            "spark.sql.execution.arrow.maxBytesPerBatch": f"{1 << 22}b",             # a chunk is a batch of its own
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):     # a round's shuffle goes with it
        return learn_network(docs, labels, language, id_col, text_col, label_col), language


def maybe_in(rows: DataFrame, id_col: str, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` less most of those whose id is no key, told by a broadcast bitmap: a join then moves fewer texts."""
    bits = 1 << min(26, max(10, (32 * keys.count()).bit_length()))  # in words of 64
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(bits))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(c, F.lit(64)).cast("int"))
    words = (keys.select(place(key).alias("_place")).groupBy(F.floor(F.col("_place") / 64).alias("_word"))
             .agg(F.bit_or(bit(F.col("_place"))).alias("_mask")))
    found = rows.withColumn("_place", place(id_col)).join(F.broadcast(words), F.floor(F.col("_place") / 64) == F.col("_word"))
    return found.where(F.col("_mask").bitwiseAND(bit(F.col("_place"))) != 0).select(rows.columns)


def learn_network(docs: DataFrame, labels: DataFrame, language: langid.Model, id_col: str, text_col: str, label_col: str) -> Network:
    """The network, fitted and calibrated."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    y = scratch.save(labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)").distinct())
    keyed = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), utf8(docs, text_col).alias("text"), F.xxhash64(text_col, id_col).alias("o"))
    texts = maybe_in(keyed, "id", y, "_id")
    marks = scratch.save(texts.select("id", "o", F.octet_length("text").alias("size")).join(y, F.col("id") == F.col("_id"))
                         .select("id", "o", "y", "size"))
    n, pos, size = marks.agg(F.count(F.lit(1)), F.sum("y"), F.sum("size")).first()
    marks = marks.select("id", "o", "y").distinct()  # repeated documents are repeated texts
    if n == 0 or pos in (0, n):
        net = Network([])
        net.constant = float(pos / n) if n else 0.0
        return net
    shared, keep_out = Shared(spark, language), True
    chunks = max(-(-n // CHUNK_ROWS), -(-size // CHUNK_BYTES))
    packed = encoded(scratch, texts, marks, chunks, shared, keep_out)
    sides = packed.agg(*[F.sum(x) for x in ("fit_pos", "fit_neg", "out_pos", "out_neg")]).first()
    if 0 in tuple(sides):
        keep_out = False
        scratch.drop(packed)
        packed, sides = encoded(scratch, texts, marks, chunks, shared, keep_out), (pos, n - pos)
    scratch.drop(y)
    shared.destroy()
    net = Network(*known_features(scratch, packed))
    fit(packed, net, chunks, sides[0], sides[1])
    net.seen = None
    net.calibrate(best_cuts(scratch, logits(packed, net, keep_out)))
    scratch.drop(packed)
    return net


def score(docs: DataFrame, net: Network, language: langid.Model, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each text, in 0 to 1; ``CUT`` is its language's threshold."""
    shared = Shared(docs.sparkSession, (net, language))

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        net, language = shared.value
        texts = text.to_pylist()
        return pa.array([net.score(v, language.predict(t)[0]) for t, v in zip(texts, word_vectors(net, texts), strict=True)], pa.float64())

    return docs.withColumn(into, scored(F.col(text_col).cast("string").cast("binary")))
