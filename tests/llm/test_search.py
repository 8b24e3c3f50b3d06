"""Search: results and scores against scoring every document."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import search
from riskengine.llm.common import ALNUM, words


def by_hand(rows, queries, k):
    docs = [(i, words((t or "").encode(), ALNUM)) for i, t in rows]
    n, average = len(docs), sum(len(w) for _, w in docs) / len(docs)
    df = {}
    for _, ws in docs:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = {}
    for q, text in queries:
        scored = []
        for i, ws in docs:
            s = 0.0
            for w in set(words((text or "").encode(), ALNUM)):
                tf = ws.count(w)
                if tf:
                    s += math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / average))
            if round(s, 6) > 0:
                scored.append((-round(s, 6), math.inf if i is None else i, i))
        out[q] = [(i, -s) for s, _, i in sorted(scored, key=lambda x: x[:2])[:k]]
    return out


def corpus(seed, n=300):
    rnd = random.Random(seed)
    vocab = [f"t{i}" for i in range(500)]
    rows = [(i, " ".join(rnd.choice(vocab[:rnd.choice([8, 60, 500])]) for _ in range(rnd.randrange(1, 60)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "t1 " * 5000), (None, rows[0][1]), (11, rows[10][1]), (20, rows[20][1])]


@pytest.mark.parametrize("seed,shard,block,k", [(1, 4096, 64, 10), (2, 37, 8, 10), (3, 20, 4, 1), (4, 50, 16, 400)])
def test_results_are_exact(spark, documents, monkeypatch, seed, shard, block, k):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "CHUNK", 7)
    rows = corpus(seed)
    queries = [(i, t) for i, t in rows if i is not None and i % 20 == 0 and i < 300]
    queries = list({i: t for i, t in queries}.items())
    got = {}
    for r in search.top_k(documents(rows), F.col("doc_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.doc_id, r.score))
    want = by_hand(rows, queries, k)
    assert set(got) >= {q for q, w in want.items() if w}
    for q, w in want.items():
        assert [x[1] for x in got[q]] == [i for i, _ in w] and [x[0] for x in got[q]] == list(range(1, len(w) + 1))
        assert np.allclose([x[2] for x in got[q]], [s for _, s in w], atol=2e-6)


def test_batches_of_queries_give_the_same(spark, documents, monkeypatch):
    rows = corpus(5)
    run = lambda: sorted(map(tuple, search.top_k(documents(rows), F.col("doc_id") % 10 == 0, 5).collect()))
    whole = run()
    monkeypatch.setattr(search, "BATCH_TERMS", 100)
    assert run() == whole


@pytest.mark.parametrize("batch_terms", [2_000_000, 3])
def test_texts_of_one_id_are_queries_each(spark, documents, monkeypatch, batch_terms):
    monkeypatch.setattr(search, "BATCH_TERMS", batch_terms)
    rows = [(1, "a b"), (2, "c d"), (4, "a b c"), (4, "d e"), (4, "d e"), (6, "e f"), (7, "f")]
    want = []
    for q, text in sorted({r for r in rows if r[0] % 2 == 0}):
        want += [(q, n, i, s) for n, (i, s) in enumerate(by_hand(rows, [(q, text)], 3)[q], 1)]
    got = search.top_k(documents(rows), F.col("doc_id") % 2 == 0, 3).collect()
    assert sorted((r.query_id, r.rank, r.doc_id, round(r.score, 5)) for r in got) == sorted((*w[:3], round(w[3], 5)) for w in want)


def test_blocks_are_skipped_and_nothing_is_lost():
    """Two kinds of documents: a query of one kind never scores a block of the other."""
    rnd = np.random.default_rng(1)
    texts = [rnd.integers(0, 50, 40).astype(np.uint64) + np.uint64(1000 * (i % 2)) for i in range(256)]
    row = dict(zip([c.split()[0] for c in search.SHARD.split(", ")], search.build_shard(list(range(256)), list(texts))))
    batch = search.Batch(np.array([0]), [np.unique(texts[0])], [np.ones(len(np.unique(texts[0])))])
    shard = search.Shard(row, batch.vocabulary, 40.0)
    best, found = np.full((1, 3), -1.0), np.full((1, 3), search.NO_ID)
    search.search_shard(shard, batch, np.array([0]), best, found)
    assert found[0, 0] == 0 and (found[0] % 2 == 0).all()
    bound = sum(shard.most[shard.most_begin[t]:shard.most_begin[t + 1]].sum() for t in range(len(shard.place)))
    assert bound > 0 and shard.blocks == 2


def test_empty_tables_and_queries(spark, documents):
    every = F.lit(True)
    assert search.top_k(documents([]), every).collect() == []
    assert search.top_k(documents([(1, None), (2, "--"), (3, "")]), every).collect() == []
    assert search.top_k(documents([(1, "a")]), F.lit(False)).collect() == []
    got = search.top_k(documents([(1, "a b"), (2, "b c")]), every).collect()
    assert {(r.query_id, r.rank, r.doc_id) for r in got} == {(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)}


NAMES = [c.split()[0] for c in search.SHARD.split(", ")]


def index_rows(texts, size):
    return [dict(zip(NAMES, search.build_shard(list(range(lo, lo + size)), [t.copy() for t in texts[lo:lo + size]]), strict=True))
            for lo in range(0, len(texts), size)]


def searched(rows, batch, k, average):
    """What one task finds in index rows that arrive one at a time: {query: [(-score, doc_id)]}."""
    class Held:
        value = batch

    out = list(search._search(Held, k, average, 0)(pa.RecordBatch.from_pylist([r]) for r in rows))
    got = {}
    for b in out:
        for q, doc, score in zip(*(b.column(c).to_pylist() for c in ("query", "doc_id", "score")), strict=True):
            got.setdefault(q, []).append((-score, doc))
    return {q: sorted(x)[:k] for q, x in got.items()}


def by_sum(texts, queries, weights, k, average):
    """The same by plain sums over every document."""
    out = {}
    for q, (terms, weight) in enumerate(zip(queries, weights, strict=True)):
        scored = []
        for i, t in enumerate(texts):
            tf = (t[:, None] == terms).sum(axis=0)
            s = round(float((weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / average))).sum()), 6)
            scored += [(-s, i)] * (s > 0)
        out[q] = sorted(scored)[:k]
    return {q: x for q, x in out.items() if x}


@pytest.mark.parametrize("long,few,chunk,strip,group", [(32, 4, 256, 4, 12288), (0, 1, 7, 1, 150), (10_000, 3, 5, 2, 10_000)])
def test_rows_searched_together_give_the_sums(monkeypatch, long, few, chunk, strip, group):
    """Two kinds of documents, some of them alike: few shards are searched, and every way to add up postings is exact."""
    for name, value in (("LONG", long), ("FEW", few), ("CHUNK", chunk), ("STRIP", strip), ("GROUP_DOCS", group), ("BLOCK", 16)):
        monkeypatch.setattr(search, name, value)
    rnd = np.random.default_rng(3)
    texts = [(rnd.zipf(1.4, rnd.integers(1, 60)) % 300 + 1000 * (i // 200 % 2)).astype(np.uint64) for i in range(800)]
    texts[30:50] = [texts[30]] * 20  # ties go by id
    average = np.mean([len(t) for t in texts])
    queries = [np.unique(t) for t in texts[::20]]
    rare = {int(t): w for t, w in zip(np.unique(np.concatenate(texts)), rnd.random(2000) * 9, strict=False)}
    weights = [np.array([rare[int(t)] for t in q]) for q in queries]
    made = []

    class Counted(search.Shard):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self.n)

    monkeypatch.setattr(search, "Shard", Counted)
    rows = index_rows(texts, 50)
    got = searched(rows, search.Batch(np.arange(len(queries)), queries, weights), 10, average)
    want = by_sum(texts, queries, weights, 10, average)
    assert got.keys() == want.keys()
    for q in want:
        assert [d for _, d in got[q]] == [d for _, d in want[q]] and np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], atol=2e-6)
    assert sum(made) == 800 and len(made) <= max(3, 800 // group + 4) < len(rows)


def test_postings_are_of_native_types():
    """A dtype that travelled as bytes takes ufunc.at's slow loop, 20 times as long; each shard makes its own."""
    shard = search.Shard(index_rows([np.arange(i, i + 5, dtype=np.uint64) for i in range(100)], 100)[0], np.arange(104, dtype=np.uint64), 5.0)
    assert len(shard.postings) == 500
    assert shard.postings["score"].dtype is np.dtype(np.float64) and shard.postings["doc"].dtype is np.dtype(np.int64)


def test_documents_are_sorted_by_kind(monkeypatch):
    """Shards hold one kind where there is enough of it, and every document once."""
    monkeypatch.setattr(search, "SHARD_DOCS", 100)
    rnd = np.random.default_rng(5)
    texts = [" ".join(f"{'abc'[i % 3]}{x}" for x in rnd.zipf(1.3, 40) % 50) if i % 40 else None for i in range(600)]
    batch = pa.record_batch([pa.array(range(600)), pa.array([t and t.encode() for t in texts], pa.binary())], ["doc_id", "text"])
    rows = [r for b in search._shards([batch]) for r in b.to_pylist()]
    ids = [np.frombuffer(r["ids"], np.int64) for r in rows]
    assert sorted(np.concatenate(ids).tolist()) == list(range(600))
    pure = sum(np.bincount(i % 3).max() for i in ids)
    assert pure > 0.9 * 600 and len(rows) <= 12


def test_kinds_of_few_and_of_empty_texts():
    empty, one = np.zeros(0, np.uint64), np.array([7], np.uint64)
    for texts in ([empty], [empty, empty], [one], [one, empty, one]):
        assert len(search.kinds(list(texts))) == len(texts)
