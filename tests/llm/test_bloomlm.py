"""Bloom-filter language model: exact parts by hand, quantised parts within their bounds."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import bloomlm
from riskengine.llm.common import Scratch, bucket_of, tally


def tokens(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split() + [None]


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    rows = [(i, " ".join(rnd.choice(vocab[:rnd.choice([5, 50, 400])]) for _ in range(rnd.randrange(0, 120)))) for i in range(n)]
    return rows + [(500, None), (501, ""), (502, "UPPER upper"), (502, "UPPER upper"), (None, "w1 w2 unseen"), (503, "w1 " * 20_000)]


@pytest.mark.parametrize("common", [1 << 18, 40, 0])
def test_base_score_is_exact(spark, documents, monkeypatch, common):
    """All counts from the broadcast table, some, and none."""
    monkeypatch.setattr(bloomlm, "COMMON", common)
    rows = corpus(1)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(t for i, x in rows if i is not None and not held(i) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), held(i), len(tokens(x)), sum(count[t] > 0 for t in tokens(x)), n,
                   round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(x)), 5)) for i, x in rows)
    got = bloomlm.score(documents(rows)).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


class Filter:
    """One order's segments of all buckets, asked by key."""

    def __init__(self, n, segments, buckets):
        self.n, self.buckets, self.held = n, buckets, bloomlm.Filter(segments, 0, buckets)

    def levels(self, keys):
        codes = bloomlm.coded(keys, self.n, self.buckets)
        return self.held.levels(codes, bucket_of(keys, self.buckets)).astype(np.int64)


class Model:
    """All segments in one process: scores without slices, ranges and requests."""

    def __init__(self, merged, buckets, tokens, types, order):
        rows = merged.select("n", "bucket", "segment").collect()
        self.tokens, self.types, self.buckets = tokens, types, buckets
        self.filters = [Filter(n, {r.bucket: bytes(r.segment) for r in rows if r.n == n}, buckets) for n in range(1, order + 1)]

    def log_probabilities(self, texts):
        first = np.cumsum([0, *[len(t) for t in texts[:-1]]])
        counts = [bloomlm.middle(f.levels(np.concatenate([bloomlm.ngram_keys(t, f.n) for t in texts]))) for f in self.filters]
        return bloomlm.smoothed(counts, first, self.tokens, self.types)


def learned(spark, documents, rows, order=2):
    return Model(*bloomlm.count(Scratch(spark, "test"), documents(rows), order), order)


def ngrams(texts, n):
    keys = np.concatenate([bloomlm.ngram_keys(bloomlm.token_hashes(t.encode() if t else t), n) for t in texts])
    return tally(keys)


@pytest.mark.parametrize("bucket_tokens", [1_000_000, 500])
def test_filter_holds_every_level(spark, documents, monkeypatch, bucket_tokens):
    """No n-gram is below its level, and few are above it; absent ones mostly have none."""
    monkeypatch.setattr(bloomlm, "BUCKET_TOKENS", bucket_tokens)
    rows = corpus(2)
    model = learned(spark, documents, rows)
    for n in (1, 2):
        keys, counts = ngrams([t for _, t in rows], n)
        level, got = bloomlm.level_of(counts), model.filters[n - 1].levels(keys)
        assert (got >= level).all() and (got > level).mean() < 0.03
        absent = np.random.default_rng(n).integers(0, 1 << 63, 20_000).astype(np.uint64)
        assert (model.filters[n - 1].levels(absent) > 0).mean() < 0.02
    assert model.tokens == sum(len(tokens(t)) for _, t in rows)


def test_levels_and_middles():
    assert bloomlm.level_of(np.array([0, 1, 2, 3, 4, 7, 8])).tolist() == [0, 1, 2, 2, 3, 3, 4]
    assert bloomlm.middle(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


def test_scores_follow_the_quantised_counts(spark, documents):
    """With every probe right, a token's probability is the stated interpolation."""
    rows = [(1, "a b a b a c"), (2, "a b b")]
    model = learned(spark, documents, rows)
    count = {n: dict(zip(*(x.tolist() for x in ngrams([t for _, t in rows], n)))) for n in (1, 2)}
    h = bloomlm.token_hashes(b"a b c x")
    one, two = bloomlm.ngram_keys(h, 1), bloomlm.ngram_keys(h, 2)
    q = lambda n, k: float(bloomlm.middle(bloomlm.level_of(np.array([count[n].get(int(k), 0)])))[0])
    want = []
    for i in range(len(h)):
        p = (q(1, one[i]) + 1) / (model.tokens + model.types + 1)
        past = q(1, one[i - 1]) if i else 0
        if past:
            p = 0.6 * min(1, q(2, two[i]) / past) + 0.4 * p
        want.append(math.log10(p))
    assert np.allclose(model.log_probabilities([h]), want)


@pytest.mark.parametrize("common", [1 << 18, 0])
def test_scores_use_every_ngram_however_large_the_corpus(spark, documents, monkeypatch, common):
    """The filter outgrows the 32 MB that once bounded it, scaled down with the corpus; scores are the whole filter's."""
    monkeypatch.setattr(bloomlm, "COMMON", common)
    monkeypatch.setattr(bloomlm.score, "__defaults__", tuple(1500 if d == 32 << 20 else d for d in bloomlm.score.__defaults__))
    monkeypatch.setattr(bloomlm, "BUCKET_TOKENS", 2000)
    monkeypatch.setattr(bloomlm, "SCORE_BYTES", 4000)
    rows = corpus(4)
    kept = [(i, t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    model = learned(spark, documents, kept)
    assert model.buckets > 4
    want = sorted((str(i), round(float(model.log_probabilities([bloomlm.token_hashes(t.encode() if t else t)]).sum()), 5)) for i, t in rows)
    assert sorted((str(r.doc_id), round(r.score, 5)) for r in bloomlm.score(documents(rows)).collect()) == want


def test_longer_ngrams_and_likelier_texts(spark, documents):
    rows = [(i, "the cat sat on the mat and the dog sat on the rug") for i in range(40)]
    model = learned(spark, documents, rows, order=2)
    p = lambda t: model.log_probabilities([bloomlm.token_hashes(t.encode())]).sum()
    assert p("the cat sat on the mat") > p("mat the on sat cat the") > p("unknown words only stand in here")


def test_trigrams_interpolate_down_to_words(spark, documents):
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = list(zip(ids, ["a b a b a c", "a b b", "a b a"]))
    model = learned(spark, documents, rows, order=3)
    count = {n: dict(zip(*(x.tolist() for x in ngrams([t for _, t in rows], n)))) for n in (1, 2, 3)}
    q = lambda n, k: float(bloomlm.middle(bloomlm.level_of(np.array([count[n].get(int(k), 0)])))[0])
    want = {}
    for i, t in rows:
        h = bloomlm.token_hashes(t.encode())
        keys = {n: bloomlm.ngram_keys(h, n) for n in (1, 2, 3)}
        want[i] = 0.0
        for at in range(len(h)):
            p = (q(1, keys[1][at]) + 1) / (model.tokens + model.types + 1)
            for n in (2, 3):
                past = q(n - 1, keys[n - 1][at - 1]) if at else 0
                if past:
                    p = 0.6 * min(1, q(n, keys[n][at]) / past) + 0.4 * p
            want[i] += math.log10(p)
    got = {r.doc_id: r.score for r in bloomlm.score(documents(rows), order=3).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("bucket_tokens", [1_000_000, 100, 20])
def test_rows_do_not_grow_with_the_buckets(spark, documents, monkeypatch, bucket_tokens):
    """A slice sends a row of documents and at most one a range and order, and a task's run likewise."""
    monkeypatch.setattr(bloomlm, "BUCKET_TOKENS", bucket_tokens)
    monkeypatch.setattr(bloomlm, "SCORE_BYTES", 20_000)
    docs = documents(corpus(5)).coalesce(1)
    merged, buckets, _, _ = bloomlm.count(Scratch(spark, "test"), docs)
    ranges = bloomlm.ranges_of(spark, buckets)
    assert bucket_tokens > 100 or buckets > 10 * ranges
    shared = spark.sparkContext.broadcast(bloomlm.common_words(merged, 0))
    rows = bloomlm.requests(docs, shared, 2, buckets).groupBy("slice").count().collect()
    assert rows and all(r["count"] <= 1 + 2 * ranges for r in rows)
    runs = docs.select(bloomlm.utf8(docs)).mapInArrow(bloomlm._tally_tasks(2, buckets, ranges), bloomlm.RUNS)
    assert runs.count() <= 2 * ranges


def test_ranges_do_not_change_results(spark, documents, monkeypatch):
    monkeypatch.setattr(bloomlm, "BUCKET_TOKENS", 1000)
    monkeypatch.setattr(bloomlm, "SCORE_BYTES", 4000)
    got, docs = [], documents(corpus(8))
    for ranges in (1, 3, 8):
        monkeypatch.setattr(bloomlm, "ranges_of", lambda spark, buckets, ranges=ranges: min(ranges, buckets))
        got.append(sorted(map(str, bloomlm.score(docs).collect())))
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("limit", [0, 1, 40, 150, 1 << 18])
def test_common_words_are_the_most_frequent(spark, documents, monkeypatch, limit):
    """However many buckets there are; never more than the limit, none rarer than one left out."""
    monkeypatch.setattr(bloomlm, "BUCKET_TOKENS", 20)
    rows = corpus(6)
    merged, _, _, _ = bloomlm.count(Scratch(spark, "test"), documents(rows))
    keys, rank, n, level = bloomlm.common_words(merged, limit)
    all_keys, all_counts = ngrams([t for _, t in rows], 1)
    assert len(keys) == len(n) == len(level) <= limit and (limit < 40 or len(keys) > limit // 4 or len(keys) == len(all_keys))
    exact = dict(zip(all_keys.tolist(), all_counts.tolist()))
    assert [exact[k] for k in keys.tolist()] == n[rank].tolist()
    assert (np.diff(keys.astype(object)) > 0).all() and (np.diff(n) <= 0).all()
    left = [c for k, c in exact.items() if k not in set(keys.tolist())]
    assert not len(n) or not left or n.min() > max(left)


def test_documents_are_dealt_over_ranges(spark, documents, monkeypatch):
    """Also where the ranges are a power of two, as the numbers of tasks are multiples of one."""
    monkeypatch.setattr(bloomlm, "BUCKET_TOKENS", 20)
    docs = documents(corpus(9)).repartition(40, "doc_id")
    shared = spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0, np.int64), None, None))
    got = bloomlm.requests(docs, shared, 2, 1000).where("n = 0").groupBy("range").count().collect()
    assert len(got) > 4 and max(r["count"] for r in got) < 20


def test_packed_columns_round_trip():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5000):
        codes = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
        assert (bloomlm._from_gaps(bloomlm._gaps(codes)) == codes).all()
        small = rng.integers(0, 1 << 32, size).astype(np.uint32)
        assert (bloomlm._unsqueezed(bloomlm._squeezed(small), np.uint32) == small).all()


def test_clashing_names(spark, documents):
    rows = corpus(7, 20)
    docs = documents(rows)
    for c in ("range", "n", "slice", "bucket", "keys", "counts", "levels", "segment", "ids", "held", "sizes", "places"):
        docs = docs.withColumn(c, bloomlm.F.lit("x"))
    want = sorted(map(str, bloomlm.score(documents(rows)).collect()))
    assert sorted(map(str, bloomlm.score(docs).collect())) == want


def test_empty_tables(spark, documents):
    assert bloomlm.score(documents([])).collect() == []
    only = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    got = bloomlm.score(documents([(i, "a b") for i in only])).collect()   # nothing to learn from
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, 0.0)] * 2
