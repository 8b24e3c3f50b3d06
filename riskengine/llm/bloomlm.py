"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

1. Every n-gram of every learning document is counted: tasks hash and tally their n-grams in
   numpy and send them as sorted runs.  The hash's leading bits give even buckets (so no n-gram,
   however common, makes a bucket heavy), and consecutive buckets are a range.  A run goes out as
   one row a range; ranges are as many as the session's shuffle partitions at most, so rows grow
   with the text alone, not with the buckets; results don't depend on them.  A range's task cuts runs into buckets, sorts them there and
   merges one bucket at a time.
2. A count ``c`` has level ``1 + floor(log2 c)``; the filter holds the n-gram once for each level
   up to its own.  Each bucket fills its own segment, sized from its own entries, so every n-gram
   is held; segments are a written table by bucket that grows with the corpus.
3. A probability comes from repeated probes: levels are asked for until one is missing, the last
   one's middle is the count, and the n-gram's share of its history is interpolated with the
   share of the shorter n-gram, down to add-one smoothed words.  A slice of texts sends its
   distinct n-grams, a row a range, to the range's task and gets their levels back: the task reads
   the range's segments, then answers the slices one after another, so it holds one range of the
   filter and nothing of it passes the driver.  N-grams longer than words travel, and are counted,
   as 32 bits within their bucket: in a bucket of ``BUCKET_TOKENS`` one in some 17,000 meets
   another, far fewer than the filter's own false hits.

The exact add-one unigram score is computed beside it: counts and levels of the ``COMMON`` most
frequent tokens at most are broadcast, and all other tokens are looked up by their range, exactly.

Tokens are lower-cased words (A-Z) and one end of text.  Defined cases: a null text is empty
and scores its end alone; a null id is not learned from and not held out; without learning
documents every count is zero; rows repeat freely, each is learned from and scored; a very long
text is a slice of its own, scored whole; equal counts need no order, since which words are
broadcast doesn't change a result.  Only the id and text columns are read, so other columns may
have any names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, MIX, Scratch, bucket_of, mixed, tally, utf8, word_hashes, words
from .langid import fold

ORDER = 2
TASK_TOKENS = 1_000_000        # tokens that a task tallies at once
SCORE_BYTES = 3_000_000        # bytes of text that a task scores at once
ANSWER_CODES = 500_000         # n-grams that a task answers at once
BUCKET_TOKENS = 250_000        # tokens of a bucket
BITS_PER_ENTRY, PROBES = 12, 4
COMMON = 1 << 18               # words whose counts are broadcast, at most
STEPS = 4                      # steps of an octave in which the least count of a common word is chosen
SHARE = 0.6                    # weight of a longer n-gram's own share in the interpolation, at any order
END = np.uint64(0x5BD1E9955BD1E995)
START = np.uint64(0xC2B2AE3D27D4EB4F)


def token_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of a text's tokens, the end included."""
    return np.append(word_hashes(words(text, LOWER)), END)


def ngram_keys(h: np.ndarray, order: int) -> np.ndarray:
    """Keys of the n-grams that end at each token; starts of text fill short histories."""
    key = mixed(h + np.uint64(order))
    for back in range(1, order):
        shifted = np.concatenate([np.full(min(back, len(h)), START), h[:max(0, len(h) - back)]])
        key = mixed(key * MIX + shifted)
    return key


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, np.frexp(np.maximum(counts, 1).astype(np.float64))[1], 0)


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level; 0 for level 0."""
    low = np.ldexp(0.5, level)
    return np.where(level > 0, (low + 2 * low - 1) / 2, 0.0)


def coded(keys: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Words keep their keys; longer n-grams are their bucket and 32 bits.  Both order by bucket."""
    return keys if n == 1 else bucket_of(keys, buckets).astype(np.uint64) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)


def code_bucket(codes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    return bucket_of(codes, buckets) if n == 1 else (codes >> np.uint64(32)).astype(np.int64)


def _bounds(buckets: int, ranges: int) -> np.ndarray:
    """The first bucket of each range, and the end; bucket ``b`` is in range ``b * ranges // buckets``."""
    return -(-np.arange(ranges + 1) * buckets // ranges)


def _cuts(codes: np.ndarray, n: int, buckets: int, ranges: int) -> np.ndarray:
    """Where each range begins among sorted codes, and the end."""
    bounds = _bounds(buckets, ranges)
    if n == 1:
        return np.searchsorted(bucket_of(codes, buckets), bounds)
    return np.searchsorted(codes, bounds.astype(np.uint64) << np.uint64(32))


def _probes(codes: np.ndarray, level: int):
    """Start and step of the probes of n-grams at a level; probe i is place ``_place(a, b, i, size)``."""
    a = mixed((codes & np.uint64(0xFFFFFFFF)) + np.uint64(level * int(MIX) % (1 << 64)))
    return a, (a >> np.uint64(32)) | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, i: int, size: np.ndarray) -> np.ndarray:
    """The place of probe ``i`` within segments of ``size`` bits."""
    return ((a + np.uint64(i) * b) & np.uint64(0xFFFFFFFF)) * size >> np.uint64(32)


def fill_segment(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """A bucket's bits, packed: an entry for every level of every n-gram."""
    level = level_of(counts)
    bits = np.zeros(-(-max(8, int(level.sum()) * BITS_PER_ENTRY) // 8) * 8, np.uint8)
    size = np.full(1, len(bits), np.uint64)
    for q in range(1, int(level.max(initial=0)) + 1):
        a, b = _probes(codes[level >= q], q)
        for i in range(PROBES):
            bits[_place(a, b, i, size)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """Segments of one order's filter, for consecutive buckets from ``first``; a bucket without n-grams has none."""

    def __init__(self, segments: dict[int, bytes], first: int, buckets: int):
        own = [segments.get(first + i) or bytes(1) for i in range(buckets)]
        sizes = [len(s) for s in own]
        self.first = first
        self.bits = np.frombuffer(b"".join(own), np.uint8)
        self.start = np.cumsum([0, *sizes[:-1]]).astype(np.uint64) * np.uint64(8)
        self.size = np.array(sizes, np.uint64) * np.uint64(8)

    def levels(self, codes: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The highest level up to which every probe hits, for codes of these buckets."""
        level = np.zeros(len(codes), np.uint8)
        bucket = bucket - self.first
        alive, q = np.arange(len(codes)), 1
        while len(alive):
            size, start = self.size[bucket[alive]], self.start[bucket[alive]]
            a, b = _probes(codes[alive], q)
            for i in range(PROBES):  # most absent n-grams end at the first probe
                at = _place(a, b, i, size) + start
                hit = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if not hit.all():
                    alive, a, b, size, start = alive[hit], a[hit], b[hit], size[hit], start[hit]
            level[alive] = q
            q += 1
        return level


def smoothed(counts: list[np.ndarray], first: np.ndarray, tokens: int, types: int) -> np.ndarray:
    """log10 of each token's probability from its n-grams' counts by order; texts start at ``first``."""
    own = counts[0]
    p = (own + 1) / (tokens + types + 1)
    for n in range(2, len(counts) + 1):
        past = np.concatenate([[0.0], own[:-1]])  # the history is the shorter n-gram of the token before
        past[first] = 0
        own = counts[n - 1]
        share = np.minimum(1.0, own / np.maximum(past, 1))
        p = np.where(past > 0, SHARE * share + (1 - SHARE) * p, p)
    return np.log10(p)


# --- packed columns ---------------------------------------------------------------------

def _squeezed(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed planes of their bytes."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return len(values).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unsqueezed(held: bytes, kind) -> np.ndarray:
    n, wide = int.from_bytes(held[:4], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(held[4:], decompressed_size=n * wide, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(wide, -1).T).view(kind).reshape(-1)


def _gaps(codes: np.ndarray) -> bytes:
    """Sorted codes by their differences."""
    return _squeezed(np.diff(codes, prepend=np.zeros(1, np.uint64)))


def _from_gaps(held: bytes) -> np.ndarray:
    return np.cumsum(_unsqueezed(held, np.uint64), dtype=np.uint64)


# --- counting ---------------------------------------------------------------------------

RUNS = "range int, n int, keys binary, counts binary"
PIECES = "n int, bucket long, keys binary, counts binary"
MERGED = "range int, n int, bucket long, segment binary, tokens long, types long, keys binary, counts binary, levels binary"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _tally_tasks(order: int, buckets: int, ranges: int):
    """A row for each range that a task's run of n-grams has: sorted codes and their counts."""

    def flush(held):
        for n in range(1, order + 1):
            codes, counts = tally(coded(np.concatenate([ngram_keys(h, n) for h in held]), n, buckets))
            cuts, counts = _cuts(codes, n, buckets, ranges), counts.astype(np.uint32)
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([n] * len(some), pa.int32()),
                 pa.array([_gaps(codes[cuts[i]:cuts[i + 1]]) for i in some], pa.binary()),
                 pa.array([_squeezed(counts[cuts[i]:cuts[i + 1]]) for i in some], pa.binary())], _names(RUNS))

    def run(batches):
        held, size = [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                h = token_hashes(t)
                held.append(h)
                size += len(h)
                if size >= TASK_TOKENS:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _cut(buckets: int):
    """Runs of a range cut into pieces of a bucket."""

    def run(batches):
        for b in batches:
            for _, n, keys, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                codes, counts = _from_gaps(keys), _unsqueezed(counts, np.uint32)
                bucket = code_bucket(codes, n, buckets)
                at = np.r_[np.flatnonzero(np.diff(bucket, prepend=-1)), len(codes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n] * (len(at) - 1), pa.int32()), pa.array(bucket[at[:-1]], pa.int64()),
                     pa.array([codes[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                     pa.array([counts[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())], _names(PIECES))

    return run


def _merge(buckets: int, ranges: int):
    """Each bucket's filter segment and totals, from its pieces in a row; words keep their counts, and levels in the filter."""

    def merged(n, bucket, keys, counts):
        codes, counts = tally(np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(counts), np.uint32).astype(np.int64))
        segment = fill_segment(codes, counts)
        own = [b""] * 3
        if n == 1:
            levels = Filter({bucket: segment}, bucket, 1).levels(codes, np.full(len(codes), bucket))
            own = [codes.tobytes(), counts.tobytes(), levels.tobytes()]
        row = [bucket * ranges // buckets, n, bucket, segment, int(counts.sum()), len(codes), *own]
        return pa.RecordBatch.from_pylist([dict(zip(_names(MERGED), row, strict=True))], pa.schema(
            [("range", pa.int32()), ("n", pa.int32()), ("bucket", pa.int64()), ("segment", pa.binary()), ("tokens", pa.int64()),
             ("types", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("levels", pa.binary())]))

    def run(batches):
        at, keys, counts = None, [], []
        for b in batches:
            for n, bucket, k, c in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != (n, bucket):
                    if at:
                        yield merged(*at, keys, counts)
                    at, keys, counts = (n, bucket), [], []
                keys.append(k)
                counts.append(c)
        if at:
            yield merged(*at, keys, counts)

    return run


def ranges_of(spark: SparkSession, buckets: int) -> int:
    """As many ranges as the session has shuffle partitions, but none without a bucket."""
    return min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))


def count(scratch: Scratch, docs: DataFrame, order: int = ORDER, text_col: str = "text") -> tuple[DataFrame, int, int, int]:
    """The written segments and words by bucket (``MERGED``), the buckets' number, tokens and distinct words."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = max(4, math.ceil(size / 6 / BUCKET_TOKENS))
    ranges = ranges_of(docs.sparkSession, buckets)
    runs = docs.select(utf8(docs, text_col)).mapInArrow(_tally_tasks(order, buckets, ranges), RUNS)
    pieces = runs.repartitionById(ranges, F.col("range")).mapInArrow(_cut(buckets), PIECES)
    merged = scratch.save(pieces.sortWithinPartitions("n", "bucket").mapInArrow(_merge(buckets, ranges), MERGED))
    tokens, types = merged.where("n = 1").agg(F.sum("tokens"), F.sum("types")).first()
    return merged, buckets, tokens or 0, types or 0


def common_words(merged: DataFrame, limit: int) -> tuple[np.ndarray, ...]:
    """Sorted keys and their ranks, and counts and levels by rank, of ``limit`` words at most: all
    those whose count reaches the least step that leaves no more.  Ranks of frequent words are
    small, so places compress."""
    step = lambda n: (STEPS * np.log2(n)).astype(np.int64)

    def steps(batches):
        for b in batches:
            for c in b.column(1).to_pylist():
                at, n = np.unique(step(np.frombuffer(c, np.int64)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["step", "words"])

    def above(least):
        def run(batches):
            for b in batches:
                for k, c, q in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    keys, n, q = np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64), np.frombuffer(q, np.uint8)
                    top = step(n) >= least
                    yield pa.RecordBatch.from_arrays([pa.array(keys[top].view(np.int64)), pa.array(n[top]),
                                                      pa.array(q[top].astype(np.int32))], ["key", "n", "level"])
        return run

    counts = merged.where("n = 1").select("keys", "counts", "levels")
    least, left = STEPS * 64, limit
    for at, n in sorted(counts.mapInArrow(steps, "step long, words long").groupBy("step").agg(F.sum("words")).collect(), reverse=True):
        if n > left:
            break
        least, left = at, left - n
    got = counts.mapInArrow(above(least), "key long, n long, level int").toArrow()
    keys, n, q = got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy(), got.column("level").to_numpy()
    order = np.lexsort((keys, -n))
    keys, n, q = keys[order], n[order], q[order].astype(np.uint8)
    rank = np.argsort(keys)
    return keys[rank], rank, n, q


# --- scoring ----------------------------------------------------------------------------

DOCS = "ids array<bigint>, held array<boolean>, sizes array<bigint>, places binary"
DOC_TYPES = pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()
ASKED = "range int, n int, slice long, keys binary, " + DOCS
ANSWERED = "slice long, n int, range int, levels binary, counts binary, " + DOCS
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _slices(batches):
    """Batches cut to about ``SCORE_BYTES`` of text."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy().astype(np.int64))
        cuts = np.searchsorted(size, np.arange(SCORE_BYTES, size[-1] if len(size) else 0, SCORE_BYTES))
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, b.num_rows], strict=True):
            if lo < hi:
                yield b.slice(lo, hi - lo)


def _ask(shared, order: int, buckets: int, ranges: int):
    """For each slice of texts, a row (n = 0) of its documents and their tokens' places among the
    slice's distinct n-grams, and a request a range for the n-grams that aren't common words."""

    def run(batches):
        from pyspark import TaskContext
        common, rank = shared.value[:2]
        own = TaskContext.get().partitionId() << 32
        for own, b in enumerate(_slices(batches), own):
            texts = [token_hashes(t) for t in b.column(2).to_pylist()]
            places = []
            for n in range(1, order + 1):
                codes, place = np.unique(coded(np.concatenate([ngram_keys(t, n) for t in texts]), n, buckets), return_inverse=True)
                if n == 1:  # the common words' places come first
                    at = np.minimum(np.searchsorted(common, codes), max(0, len(common) - 1))
                    hit = common[at] == codes if len(common) else np.zeros(len(codes), bool)
                    place = np.where(hit, rank[at] if len(common) else 0, len(common) + np.cumsum(~hit) - 1)[place]
                    codes = codes[~hit]
                places.append(place)
                cuts = _cuts(codes, n, buckets, ranges)
                some = np.flatnonzero(cuts[1:] > cuts[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array(np.full(len(some), n, np.int32)), pa.array(np.full(len(some), own)),
                     pa.array([_gaps(codes[cuts[i]:cuts[i + 1]]) for i in some], pa.binary()),
                     *[pa.nulls(len(some), t) for t in DOC_TYPES]], _names(ASKED))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(mixed(np.array([own], np.uint64))[0]) % ranges], pa.int32()), pa.array([0], pa.int32()), pa.array([own]), pa.nulls(1, pa.binary()),
                 pa.array([b.column(0).to_pylist()], DOC_TYPES[0]), pa.array([b.column(1).to_pylist()], DOC_TYPES[1]),
                 pa.array([[len(t) for t in texts]], DOC_TYPES[2]),
                 pa.array([_squeezed(np.concatenate(places).astype("<u4"))], DOC_TYPES[3])], _names(ASKED))

    return run


def _answer(buckets: int, ranges: int):
    """Levels of the requests to a range, and exact counts of words; a slice's documents pass through.

    Rows come by range and n-gram order, the range's part of the model before the requests.
    """
    bounds = _bounds(buckets, ranges)

    def answers(n, asked, held, known, times):
        """Levels and counts for some requests; an n-gram that several slices ask for is probed once."""
        cuts = np.cumsum([0, *map(len, asked)])
        codes, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        levels, counts = held.levels(codes, code_bucket(codes, n, buckets))[inverse], None
        if n == 1:
            place = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
            counts = np.where(known[place] == codes, times[place], 0) if len(known) else np.zeros(len(codes), np.int64)
            counts = counts[inverse]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield levels[i:j].tobytes(), None if counts is None else counts[i:j].tobytes()

    def run(batches):
        at, segments, words_held, held, known, times = None, {}, [], None, None, None
        for b in batches:
            of, got, asked = [], [], []
            for i, (r, n, slice_, keys, bucket, segment, c) in enumerate(zip(
                    *(b.column(x).to_pylist() for x in ("range", "n", "slice", "keys", "bucket", "segment", "counts")), strict=True)):
                if asked and (at != (r, n) or sum(map(len, asked)) >= ANSWER_CODES):
                    got.extend(answers(at[1], asked, held, known, times))
                    asked = []
                if at != (r, n):
                    at, segments, words_held, held = (r, n), {}, [], None
                if slice_ is None:  # a bucket of the model
                    segments[bucket] = segment
                    words_held.append((keys, c))
                    continue
                of.append(i)
                if n == 0:
                    got.append((None, None))
                    continue
                if held is None:
                    held = Filter(segments, bounds[r], bounds[r + 1] - bounds[r])
                    known = np.frombuffer(b"".join(k for k, _ in words_held), np.uint64) if n == 1 else None
                    times = np.frombuffer(b"".join(c for _, c in words_held), np.int64) if n == 1 else None
                    segments, words_held = {}, []
                asked.append(_from_gaps(keys))
            if asked:
                got.extend(answers(at[1], asked, held, known, times))
            if of:
                rows = b.take(pa.array(of))
                levels, counts = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in ("slice", "n", "range")], pa.array(levels, pa.binary()), pa.array(counts, pa.binary()),
                     *[rows.column(c) for c in _names(DOCS)]], _names(ANSWERED))

    return run


def _sum_up(shared, order: int, tokens: int, types: int):
    """Scores of a slice's documents from the answers, which laid end to end by range are in its n-grams' order."""

    def run(table: pa.Table) -> pa.Table:
        _, _, common_counts, common_levels = shared.value
        table = table.sort_by([("n", "ascending"), ("range", "ascending")])
        n = table.column("n").to_numpy()
        size = np.array(table.column("sizes")[0].as_py(), np.int64)
        places = _unsqueezed(table.column("places")[0].as_py(), np.uint32).reshape(order, -1)
        joined = lambda c, k, t: np.frombuffer(b"".join(table.column(c).filter(pa.array(n == k)).to_pylist()), t)
        levels = [joined("levels", k, np.uint8) for k in range(1, order + 1)]
        levels[0] = np.concatenate([common_levels, levels[0]])
        exact = np.concatenate([common_counts, joined("counts", 1, np.int64)])[places[0]]
        first = np.cumsum(np.r_[0, size[:-1]])
        logs = smoothed([middle(q.astype(np.int64))[p] for q, p in zip(levels, places, strict=True)], first, tokens, types)
        return pa.table([pa.array(table.column("ids")[0].as_py(), pa.int64()), pa.array(table.column("held")[0].as_py(), pa.bool_()),
                         pa.array(size), pa.array(np.add.reduceat((exact > 0).astype(np.int64), first)),
                         pa.array(np.add.reduceat(np.log10(exact + 1.0), first) - size * math.log10(tokens + types + 1)),
                         pa.array(np.add.reduceat(logs, first))], _names(SCORED))

    return run


def requests(docs: DataFrame, shared, order: int, buckets: int, id_col: str = "doc_id", text_col: str = "text",
             folds: int = 7, held_out: int = 2) -> DataFrame:
    """The rows that slices of texts send (``ASKED``): one of documents, and one a range and order at most."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(id_col, folds) == held_out, F.lit(False)).alias("held_out"),
                       utf8(docs, text_col)).mapInArrow(_ask(shared, order, buckets, ranges_of(docs.sparkSession, buckets)), ASKED)


def score(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
          held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``."""
    spark = docs.sparkSession
    merged, buckets, tokens, types = count(Scratch(spark, "bloomlm"), docs.where(fold(id_col, folds) != held_out), order, text_col)
    ranges = ranges_of(spark, buckets)
    shared = spark.sparkContext.broadcast(common_words(merged, COMMON))
    asked = requests(docs, shared, order, buckets, id_col, text_col, folds, held_out)
    model = merged.select("range", "n", "bucket", "segment", "keys", "counts")
    answered = (asked.unionByName(model, allowMissingColumns=True).repartitionById(ranges, F.col("range"))
                .sortWithinPartitions("range", "n", F.col("slice").asc_nulls_first(), "bucket")
                .mapInArrow(_answer(buckets, ranges), ANSWERED))
    scored = answered.groupBy("slice").applyInArrow(_sum_up(shared, order, tokens, types), SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         "base_score", "score")
