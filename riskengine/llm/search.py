"""Exact BM25 top-k search over a sharded inverted index with block-max pruning.

* Index: each task sorts its documents into kinds (by common words, say by language) and turns them
  into shards, a written table of one row a shard with the shard's terms, postings (document,
  frequency) and lengths.  Documents of a shard are ordered so that alike ones are neighbours, and
  every ``BLOCK`` of them is a block.
* Statistics are global: document frequencies are summed over all shards by the terms' hash
  buckets, so a shard scores as the whole index would and results merge exactly.
* Search: queries go to the shards in batches of bounded size.  Shards of one kind are searched
  together, up to ``GROUP_DOCS`` documents, so that a query's cost a shard is shared by many.  The
  postings of rare terms are added up; a block's bound is its best sum and what its common terms can
  add (the sum of their block maxima, or the most that any of its documents has of all of them).
  Blocks are visited by their bounds, and common terms are scored, as a matrix product, only where a
  query's bound reaches its threshold, which rises with what is found, from strip to strip and from
  shard to shard.  A skipped block can't hold a result, so nothing is approximate.
* Merge: the k best of each task, ranked by (score to six places, doc_id).

A query is the distinct words of its whole text (0-9, a-z and non-ASCII, lower-cased).  Defined
cases: a query without words has no results; a null or empty text is never found; results with
a score of zero are none; a null id is not a query and loses ties; rows that repeat are
found as often as they are there; as queries, rows of equal id and text are one, and those of
one id but different texts are ranked each by itself, all under that id.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ALNUM, Scratch, Shared, bucket_of, packed, union_all, unpacked, utf8, word_hashes, words

K1, B = 1.2, 0.75
SHARD_DOCS, SHARD_TOKENS = 3072, 1_500_000
PAGE = 4                   # shards whose documents are sorted by kind
KINDS, HEAD = 6, 128       # kinds of documents, told by so many words of a text
READ_DOCS = 512            # documents whose texts are held at once while a shard is built
BLOCK = 128
COMMON_SHARE = 12          # a term in more than a 12th of a shard's documents is common there
BATCH_TERMS = 3_000_000    # query terms that are broadcast at once
GROUP_DOCS, GROUP_POSTINGS = 4 * SHARD_DOCS, 5_000_000  # of index rows that are searched together
CHUNK = 128                # queries that a shard handles at once
FEW, LONG = 8, 32          # queries whose rare terms are added up at once; from how many postings on a list is long
STRIP = 4                  # blocks that are scored at once
PIECE = 1024               # exact scores at once
BUCKET_KEYS = 2_000_000
PLACES = 6
NO_ID = np.iinfo(np.int64).max

SHARD = ("n_docs long, n_tokens long, ids binary, lengths binary, terms binary, starts binary, docs binary, tfs binary")


# --- index ------------------------------------------------------------------------------

def build_shard(ids: list[int | None], texts: list[np.ndarray]) -> list:
    """One shard's row from document ids and their words' hashes."""
    lengths = np.array([len(t) for t in texts], np.int32)
    n_docs = len(texts)
    doc = np.repeat(np.arange(n_docs, dtype=np.int32), lengths)
    term = np.concatenate(texts)
    texts.clear()  # a shard is large: only one copy of its words at a time
    order = np.argsort(term, kind="stable")  # by term, then document
    term, doc = term[order], doc[order]
    del order
    first = np.flatnonzero(np.r_[len(term) > 0, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])])
    tf = np.diff(np.r_[first, len(term)])
    term, doc = term[first], doc[first]
    start = np.flatnonzero(np.r_[len(term) > 0, term[1:] != term[:-1]])
    terms, starts = term[start], np.r_[start, len(term)]
    # alike documents side by side: by the most used of the shard's commonest terms, then length
    most = np.argsort(-np.diff(starts), kind="stable")[:16]
    use = np.zeros((len(most) + 1, n_docs))
    for i, t in enumerate(most):
        use[i, doc[starts[t]:starts[t + 1]]] = tf[starts[t]:starts[t + 1]]
    rank = np.lexsort((lengths, use.argmax(axis=0)))
    place = np.empty(len(rank), np.int32)
    place[rank] = np.arange(len(rank))
    doc = place[doc]
    order = np.argsort(np.repeat(np.arange(len(terms)) * n_docs, np.diff(starts)) + doc)  # by term, then place
    own = np.array([NO_ID if i is None else i for i in ids], np.int64)[rank]
    return [len(ids), int(lengths.sum()), own.tobytes(), lengths[rank].tobytes(), terms.tobytes(),
            starts.astype(np.int64).tobytes(), doc[order].astype(np.uint32).tobytes(), tf[order].astype(np.uint32).tobytes()]


def kinds(texts: list[np.ndarray]) -> np.ndarray:
    """Documents sorted into ``KINDS`` by the common words of their beginnings (k-means on cosines), say by language.

    It decides which documents are neighbours, nothing else.
    """
    heads = [t[:HEAD] for t in texts]
    doc, term = np.repeat(np.arange(len(heads)), [len(t) for t in heads]), np.concatenate(heads)
    v, n = np.unique(term[doc % -(-len(heads) // 512) == 0], return_counts=True)
    v = np.sort(v[np.argsort(-n, kind="stable")[:512]])
    if not len(v):
        return np.zeros(len(texts), np.int64)
    at = np.minimum(np.searchsorted(v, term), len(v) - 1)
    hit = v[at] == term
    x = np.zeros((len(heads), len(v)), np.float32)
    x[doc[hit], at[hit]] = 1
    n = x.sum(axis=1)
    x /= np.sqrt(np.maximum(n, 1))[:, None]
    few = n < min(16, n.max())  # tell too little to start a kind

    def unit(rows):
        mean = rows.mean(axis=0)
        return mean / max(np.sqrt(mean @ mean), 1e-9)

    centres = unit(x)[None]
    while len(centres) < KINDS:  # one more around the document least like the others
        far = ((x @ centres.T).max(axis=1) + 2 * few).argmin()
        centres = np.concatenate([centres, unit(x[np.argsort(-(x @ x[far]), kind="stable")[:32]])[None]])
    for _ in range(3):
        kind = (x @ centres.T).argmax(axis=1)
        centres = np.array([unit(x[kind == i]) if (kind == i).any() else c for i, c in enumerate(centres)])
    return (x @ centres.T).argmax(axis=1)


def _shards(batches):
    names = [c.split()[0] for c in SHARD.split(", ")]
    types = (pa.int64(), pa.int64(), *[pa.binary()] * 6)
    ids, texts, size = [], [], 0

    def flush():
        """Shards of the documents at hand, each of one kind as far as there are enough of it."""
        kind = kinds(texts)
        own, words_of, tokens, last = [], [], 0, None
        for i in np.argsort(kind, kind="stable").tolist():
            full = len(own) >= SHARD_DOCS or tokens >= SHARD_TOKENS
            if own and (full or kind[i] != last and 8 * len(own) >= SHARD_DOCS):
                yield row(build_shard(own, words_of))
                own, words_of, tokens = [], [], 0
            own.append(ids[i])
            words_of.append(texts[i])
            tokens, last, texts[i] = tokens + len(texts[i]), kind[i], None  # held once
        yield row(build_shard(own, words_of))

    def row(values):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    for b in (b.slice(lo, READ_DOCS) for b in batches for lo in range(0, b.num_rows, READ_DOCS)):
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids.append(i)
            texts.append(word_hashes(words(t, ALNUM)))
            size += len(texts[-1])
            if len(ids) >= PAGE * SHARD_DOCS or size >= PAGE * SHARD_TOKENS:
                yield from flush()
                ids, texts, size = [], [], 0
    if ids:
        yield from flush()


def build_index(scratch: Scratch, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(docs, text_col))
    return scratch.save(rows.mapInArrow(_shards, SHARD))


# --- statistics -------------------------------------------------------------------------

def _frequencies(buckets: int):
    def run(batches):
        for b in batches:
            for terms, starts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield packed(np.frombuffer(terms, np.uint64), np.diff(np.frombuffer(starts, np.int64)), buckets)

    return run


def _query_terms(buckets: int):
    """A query's distinct terms, cut by bucket."""

    def run(batches):
        for b in batches:
            out = []
            for q, t, v in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                terms = np.unique(word_hashes(words(t, ALNUM)))
                cuts = np.searchsorted(bucket_of(terms, buckets), np.arange(buckets + 1))
                out += [(q, v, i, terms[cuts[i]:cuts[i + 1]].view(np.int64)) for i in range(buckets) if cuts[i] < cuts[i + 1]]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                                              pa.array([o[2] for o in out], pa.int32()),
                                              pa.array([o[3] for o in out], pa.list_(pa.int64()))],
                                             ["query", "version", "bucket", "terms"])

    return run


def _look_up(_key, counts: pa.Table, asked: pa.Table) -> pa.Table:
    """Each query's terms of a bucket with their global document frequencies."""
    keys, n = unpacked(counts.column("keys").to_pylist(), counts.column("counts").to_pylist())
    out = []
    for q, v, t in zip(*(asked.column(c).to_pylist() for c in ("query", "version", "terms")), strict=True):
        t = np.array(t, np.int64).view(np.uint64)
        at = np.minimum(np.searchsorted(keys, t), max(0, len(keys) - 1))
        hit = keys[at] == t if len(keys) else np.zeros(len(t), bool)
        out.append((q, v, t[hit].view(np.int64), n[at[hit]]))
    return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.list_(pa.int64())),
                     pa.array([o[3] for o in out], pa.list_(pa.int64()))], ["query", "version", "terms", "df"])


# --- search -----------------------------------------------------------------------------

class Batch:
    """Queries with their terms (rows of one sorted vocabulary); a term weighs the same in every query."""

    def __init__(self, ids: np.ndarray, terms: list[np.ndarray], weights: list[np.ndarray]):
        self.ids = ids
        self.size = np.array([len(t) for t in terms], np.int64)
        self.vocabulary, term = np.unique(np.concatenate(terms), return_inverse=True)
        self.term = term.astype(np.int32)
        self.weight = np.empty(len(self.vocabulary))
        self.weight[term] = np.concatenate(weights)
        self.first = np.cumsum(np.r_[0, self.size])


class Part:
    """An index row's postings of a vocabulary."""

    def __init__(self, row: dict, vocabulary: np.ndarray):
        self.ids, self.lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int32)
        terms, starts = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["starts"], np.int64)
        at = np.searchsorted(vocabulary, terms).astype(np.int32)
        here = np.flatnonzero((at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == terms))
        self.have, lo, hi = at[here], starts[here], starts[here + 1]
        self.size = hi - lo
        self.kind = int(terms[np.diff(starts).argmax()]) if len(terms) else 0  # its commonest term
        pick = _ranges(lo, hi)
        self.doc, self.tf = np.frombuffer(row["docs"], np.uint32)[pick].astype(np.int32), np.frombuffer(row["tfs"], np.uint32)[pick]


class Shard:
    """Index rows' postings of a batch's terms; documents of several rows are searched as one shard.

    ``own`` gives a vocabulary term's row here, -1 if the shard doesn't have it.  A common term has a
    column (``place``) of dense scores and block maxima, another one a list of postings.
    """

    def __init__(self, rows: dict | list[Part], vocabulary: np.ndarray, average: float, weight: np.ndarray | None = None):
        parts = [Part(rows, vocabulary)] if isinstance(rows, dict) else rows
        self.ids = np.concatenate([p.ids for p in parts])
        self.n, self.blocks = len(self.ids), -(-len(self.ids) // BLOCK)
        self.norm = np.full(self.blocks * BLOCK, K1)
        self.norm[:self.n] = K1 * (1 - B + B * np.concatenate([p.lengths for p in parts]) / average)
        have, n, doc, tf = _merged(parts)
        self.own = np.full(len(vocabulary), -1, np.int32)
        self.own[have] = np.arange(len(have))
        self.weight = np.ones(len(have)) if weight is None else weight[have]
        begin = np.r_[0, np.cumsum(n)]
        many = n * COMMON_SHARE > self.n
        self.common = np.flatnonzero(many)
        self.place = np.full(len(n), -1, np.int32)
        self.place[self.common] = np.arange(len(self.common))
        self.tf = np.zeros((len(self.norm), len(self.common)), tf.dtype)
        for i, t in enumerate(self.common):
            self.tf[doc[begin[t]:begin[t + 1]], i] = tf[begin[t]:begin[t + 1]]
        rare = np.repeat(~many, n)
        doc, tf = doc[rare], tf[rare]
        del rare
        self.dense = np.empty(self.tf.shape, np.float32)
        self.dense_most = np.zeros((len(self.common), self.blocks))
        self.mass = np.zeros(self.blocks)  # the most that a document of the block has of all common terms
        for b in range(self.blocks):
            docs = slice(b * BLOCK, (b + 1) * BLOCK)
            score = self.impacts(docs) * self.weight[self.common]
            self.dense[docs], self.dense_most[:, b], self.mass[b] = score, score.max(axis=0, initial=0), score.sum(axis=1).max()
        self.most = self.dense_most.ravel()  # block maxima by term; a rare term's postings are added up instead
        self.most_begin = np.r_[0, np.cumsum(np.where(many, self.blocks, 0))]
        n[many] = 0
        self.begin = np.r_[0, np.cumsum(n)]  # a rare term's postings
        score = self.norm[doc]
        score += tf
        np.divide(tf * (K1 + 1), score, out=score)
        score *= np.repeat(self.weight, n)
        # made here: the fields of a dtype that was pickled miss ufunc.at's fast loop
        self.postings = np.empty(len(doc), np.dtype([("score", np.float64), ("doc", np.int64)]))
        self.postings["doc"], self.postings["score"] = doc, score

    def impacts(self, docs) -> np.ndarray:
        """The common terms' impacts in some documents."""
        tf = self.tf[docs]
        return tf * (K1 + 1) / (tf + self.norm[docs, None])


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo
    at = np.repeat(lo - (np.cumsum(n) - n), n)
    at += np.arange(len(at))
    return at


def _merged(parts: list[Part]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, their numbers of postings, and the postings of all parts by term and document; empties the list."""
    have, n = np.concatenate([p.have for p in parts]), np.concatenate([p.size for p in parts])
    first_doc = np.cumsum([0, *(len(p.ids) for p in parts)], dtype=np.int32)
    doc = np.concatenate([p.doc + o for p, o in zip(parts, first_doc[:-1], strict=True)])
    tf = np.concatenate([p.tf for p in parts])
    parts.clear()  # one copy of the postings is enough
    by_term = np.argsort(have, kind="stable")
    end = np.cumsum(n)
    pick = _ranges((end - n)[by_term], end[by_term])
    doc = doc[pick]
    tf = tf.astype(np.min_scalar_type(tf.max(initial=0)))[pick]
    have, n = have[by_term], n[by_term]
    first = np.flatnonzero(np.r_[len(have) > 0, have[1:] != have[:-1]])
    return have[first], np.add.reduceat(n, first) if len(first) else n[:0], doc, tf


def _add_rare(shard: Shard, query: np.ndarray, term: np.ndarray, partial: np.ndarray) -> None:
    """Add the scores of rare terms' postings to rows of ``partial``."""
    lo, hi = shard.begin[term], shard.begin[term + 1]
    long = hi - lo > LONG
    short = ~long
    got = shard.postings[_ranges(lo[short], hi[short])]
    np.add.at(partial.reshape(-1), np.repeat(query[short] * partial.shape[1], hi[short] - lo[short]) + got["doc"], got["score"])
    # long lists: bytes are joined, which costs less a list than arrays do
    data, kind = memoryview(shard.postings.view(np.uint8)), shard.postings.dtype
    cuts = np.searchsorted(query[long], np.arange(len(partial) + 1))
    lo, hi = (lo[long] * kind.itemsize).tolist(), (hi[long] * kind.itemsize).tolist()
    for row, some in zip(partial, map(slice, cuts[:-1], cuts[1:]), strict=True):
        got = np.frombuffer(b"".join([data[i:j] for i, j in zip(lo[some], hi[some], strict=True)]), kind)
        np.add.at(row, got["doc"], got["score"])


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    m = values.shape[1]
    return np.partition(values, m - k, axis=1)[:, m - k] if m >= k else np.zeros(len(values))


def search_shard(shard: Shard, batch: Batch, some: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
    """Raise the k best scores (by the shard's weights) and ids, rows of ``best`` and ``found``, of queries ``some``."""
    k, width = best.shape[1], shard.blocks * BLOCK
    term = shard.own[batch.term[_ranges(batch.first[some], batch.first[some + 1])]]
    query = np.repeat(np.arange(len(some)), batch.size[some])
    query, term = query[term >= 0], term[term >= 0]
    place = shard.place[term]
    rare = place < 0
    common = np.zeros((len(some), len(shard.common)), np.float32)  # weights are in the shard's scores
    common[query[~rare], place[~rare]] = 1
    query, term = query[rare], term[rare]
    partial, rough = np.zeros((len(some), width)), np.empty((len(some), width), np.float32)
    top = np.empty((len(some), shard.blocks), np.float32)
    cuts = np.searchsorted(query, np.arange(0, len(some) + FEW, FEW))
    for lo, a, b in zip(range(0, len(some), FEW), cuts[:-1], cuts[1:], strict=True):
        few = slice(lo, lo + FEW)  # whose sums stay in the cache
        _add_rare(shard, query[a:b] - lo, term[a:b], partial[few])
        rough[few] = partial[few]
        top[few] = rough[few].reshape(-1, shard.blocks, BLOCK).max(axis=2)
    # a block's bound: its best sum of rare terms, and what common terms can add there
    bound = top + np.minimum(common @ shard.dense_most, shard.mass)
    slack = 10.0 ** -PLACES + (common.shape[1] + 2) * 2.0 ** -23 * bound.max(axis=1)  # rounding, single precision

    def threshold():  # of the k best blocks' best, or of the k best documents where blocks are few
        return np.maximum(best[some, -1], _kth(top if shard.blocks >= 2 * k else rough, k) - slack)

    least = threshold()
    strips = np.arange(0, shard.blocks, STRIP)
    order = np.argsort(-np.maximum.reduceat(bound.max(axis=0), strips), kind="stable")
    for n, first in enumerate(strips[order]):
        blocks, docs = slice(first, first + STRIP), slice(first * BLOCK, (first + STRIP) * BLOCK)
        alive = np.flatnonzero(((bound[:, blocks] + slack[:, None] >= least[:, None]) & (bound[:, blocks] > 0)).any(axis=1))
        if len(alive):
            sums = rough[alive, docs] + common[alive] @ shard.dense[docs].T
            rough[alive, docs] = sums
            top[alive, blocks] = sums.reshape(len(alive), -1, BLOCK).max(axis=2)
        if n % 4 == 3 or n == len(strips) - 1:
            least = threshold()
    # single precision tells who may reach a threshold; their scores are then exact
    cut = (least - slack)[:, None]
    q, block = np.nonzero((top >= cut) & (top > 0))
    cells = rough.reshape(len(some), shard.blocks, BLOCK)[q, block]
    i, j = np.nonzero((cells >= cut[q]) & (cells > 0))
    q, doc, cells = q[i], block[i] * BLOCK + j, cells[i, j]
    order = np.lexsort((-cells, q))
    at = np.searchsorted(q, np.arange(len(some) + 1))
    full = np.flatnonzero(np.diff(at) >= k)  # the k-th best candidate tells more than the k-th best block
    cut[full, 0] = np.maximum(cut[full, 0], cells[order[at[full] + k - 1]] - 2 * slack[full])
    near = cells >= cut[q, 0]
    q, doc = q[near], doc[near]
    score = partial[q, doc]
    weight = shard.weight[shard.common]
    for lo in range(0, len(q), PIECE):
        p = slice(lo, lo + PIECE)
        score[p] += np.einsum("ij,ij->i", shard.impacts(doc[p]), common[q[p]] * weight)
    score = np.round(score, PLACES)
    q, doc, score = q[score > 0], doc[score > 0], score[score > 0]
    raised = np.unique(q)
    rows = some[raised]
    every = np.concatenate([best[rows].ravel(), score])
    ids = np.concatenate([found[rows].ravel(), shard.ids[doc]])
    q = np.concatenate([np.repeat(raised, k), q])
    order = np.lexsort((ids, -every, q))
    order = order[(np.searchsorted(q[order], raised)[:, None] + np.arange(k)).ravel()]  # a query's first k
    best[rows], found[rows] = every[order].reshape(-1, k), ids[order].reshape(-1, k)


def _search(shared, k: int, average: float, start: int):
    def run(batches):
        batch = shared.value
        best = np.full((len(batch.ids), k), -1.0)
        found = np.full((len(batch.ids), k), NO_ID)

        def flush(parts):
            shard = Shard(parts, batch.vocabulary, average, batch.weight)
            for lo in range(0, len(batch.ids), CHUNK):
                search_shard(shard, batch, np.arange(lo, min(lo + CHUNK, len(batch.ids))), best, found)

        def docs(parts):
            return sum(len(p.ids) for p in parts)

        def postings(kind):
            return sum(len(p.doc) for p in waiting[kind])

        waiting = {}  # rows of one kind are searched together
        for b in batches:
            for i in range(b.num_rows):
                part = Part(b.slice(i, 1).to_pylist()[0], batch.vocabulary)
                if docs([part, *waiting.get(part.kind, [])]) > GROUP_DOCS and part.kind in waiting:
                    flush(waiting.pop(part.kind))
                waiting.setdefault(part.kind, []).append(part)
                del part
                while sum(map(postings, waiting)) > GROUP_POSTINGS:
                    flush(waiting.pop(max(waiting, key=postings)))
        small = [k for k in waiting if 4 * docs(waiting[k]) < GROUP_DOCS]  # a shard's costs a query are the same for few documents
        mixed = [p for k in small for p in waiting.pop(k)]
        for parts in sorted([*waiting.values(), *([mixed] if mixed else [])], key=docs, reverse=True):
            flush(parts)
        q, i = np.nonzero(best > 0)
        ids = found[q, i]
        yield pa.RecordBatch.from_arrays([pa.array(batch.ids[q]), pa.array(q + start), pa.array(ids, mask=ids == NO_ID),
                                          pa.array(best[q, i])], ["query_id", "query", "doc_id", "score"])

    return run


@contextmanager
def rows_at_once(spark, n: int):
    """Hand Python tasks ``n`` rows at once: a shard's row is megabytes, and Spark's default is thousands."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def top_k(docs: DataFrame, is_query: Column, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): the ``k`` best rows of ``docs`` for each distinct row that ``is_query``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    index = build_index(scratch, docs, id_col, text_col)
    n, tokens, keys = index.agg(F.sum("n_docs"), F.sum("n_tokens"), F.sum(F.octet_length("terms") / 8)).first()
    queries = (docs.where(is_query & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
               .select(F.col(id_col).cast("long").alias("query"), utf8(docs, text_col).alias("text")).distinct()
               .withColumn("version", F.xxhash64("text")))  # tells texts of one id apart
    buckets = max(4, math.ceil((keys or 0) / BUCKET_KEYS))
    counts = index.select("terms", "starts").mapInArrow(_frequencies(buckets), "bucket int, keys binary, counts binary")
    asked = queries.mapInArrow(_query_terms(buckets), "query long, version long, bucket int, terms array<long>")
    parts = (counts.groupBy("bucket").cogroup(asked.groupBy("bucket"))
             .applyInArrow(_look_up, "query long, version long, terms array<long>, df array<long>"))
    idf = F.transform(F.flatten(F.collect_list("df")), lambda d: F.log(1 + (F.lit(float(n or 0)) - d + 0.5) / (d + 0.5)))
    with rows_at_once(spark, 8):
        queries = scratch.save(parts.groupBy("query", "version").agg(F.flatten(F.collect_list("terms")).alias("terms"), idf.alias("weights"))
                               .where(F.size("terms") > 0))
    batches = max(1, math.ceil((queries.agg(F.sum(F.size("terms"))).first()[0] or 0) / BATCH_TERMS))
    # few tasks with many shards each: a task sends k results a query, and thresholds rise from shard to shard
    shards = index.coalesce(2 * spark.sparkContext.defaultParallelism)
    results, start = [], 0
    for i in range(batches):
        got = queries.where(F.pmod(F.xxhash64("query"), F.lit(batches)) == i).orderBy(F.element_at("weights", 1), "query", "version").toArrow()
        if not got.num_rows:
            continue
        terms = [np.array(t, np.int64).view(np.uint64) for t in got.column("terms").to_pylist()]
        weights = [np.array(w) for w in got.column("weights").to_pylist()]
        shared = Shared(spark, Batch(got.column("query").to_numpy(), terms, weights))
        run = _search(shared, k, tokens / n, start)
        start += got.num_rows
        with rows_at_once(spark, 1):
            results.append(scratch.save(shards.mapInArrow(run, "query_id long, query long, doc_id long, score double")))
        shared.destroy()
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return union_all(results).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
