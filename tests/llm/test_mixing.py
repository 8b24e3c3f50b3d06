"""Mixing: targets by repeated resharing, rounding near them, reruns and marginals."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from conftest import rows_of

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import mixing
from riskengine.llm.common import Scratch


def targets_by_hand(size):
    """Shares by weight, capped at 3 sizes, the excess shared again until none is above."""
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, got, free = sum(size.values()), {}, set(order)
    while free:
        left = total - sum(got.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            return got | share
        got |= {s: 3.0 * size[s] for s in over}
        free -= over
    return got


def corpus(seed, sources=("b", "a", "ä", "Z", None, "tiny", "empty")):
    rnd = random.Random(seed)
    rows = [(1_000_000, "w " * 3, "en", "tiny"), (1_000_001, None, "en", "empty"), (1_000_002, " \n", "en", "empty")]
    for i in range(900):
        n = rnd.choice([0, 1, 5, 40, 300]) if i % 97 else 4000
        rows.append((i, "w " * n, "en", "b" if i % 3 == 0 else rnd.choice([s for s in sources if s not in ("tiny", "empty")])))
    return rows + [rows[10], rows[10], (None, "x y z", "en", "a"), (7, "again", "en", "Z")]


@pytest.mark.parametrize("seed,chunk", [(1, 256), (2, 8)])
def test_targets_and_taken(spark, documents, monkeypatch, seed, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = corpus(seed)
    size = defaultdict(int)
    for _, t, _, s in rows:
        size[s] += len((t or "").split())
    want = targets_by_hand(dict(size))
    key = {(size[s], round(want[s], 6)): s for s in want}
    df = documents(rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        s = key[r.source_size, round(r.target, 6)]
        taken[s] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    assert sum(want.values()) == pytest.approx(sum(size.values()))
    for s in want:
        assert abs(taken[s] - want[s]) <= max(1, 0.02 * want[s]), (s, taken[s], want[s])
    again = mixing.mix(df.repartition(5))
    assert rows_of(again) == sorted((tuple(r) for r in got), key=repr)


def test_rounding_keeps_probabilities_and_sum(spark):
    """Over many seeds each unit is taken as often as its probability; each run's sum is kept."""
    scratch = Scratch(spark, "test")
    p = [0.1, 0.25, 0.5, 0.5, 0.7, 0.95, 0.3, 0.7]
    units = spark.createDataFrame([(k, i, 10, 0, x) for k in range(150) for i, x in enumerate(p)], mixing.UNIT)
    runs = 4
    hits = defaultdict(int)
    for seed in range(runs):
        got = mixing.settle(scratch, units, seed).collect()
        by = defaultdict(float)
        for r in got:
            assert r.prob in (0.0, 1.0)
            by[r.key] += r.prob
            hits[r.doc_id] += r.prob
        assert all(abs(v - sum(p)) < 1 for v in by.values())
    # keys share their ids' random numbers, so the runs are few; bounds are wide
    assert 0 < sum(hits.values()) and abs(sum(hits.values()) - sum(p) * 150 * runs) <= 150 * runs


def test_single_pairs_follow_their_odds(spark):
    scratch = Scratch(spark, "test")
    units = spark.createDataFrame([(k, 2 * k + i, 5, 0, x) for k in range(4000) for i, x in enumerate((0.2, 0.8))], mixing.UNIT)
    got = mixing.settle(scratch, units).collect()
    first = [r.prob for r in got if r.doc_id % 2 == 0]
    assert abs(sum(first) / len(first) - 0.2) < 0.03
    per = defaultdict(float)
    for r in got:
        per[r.key] += r.prob
    assert set(per.values()) == {1.0}


def test_equal_rows_are_numbered_and_spread_over_chunks(spark, documents, monkeypatch):
    """A third of all rows equal, others equal in pairs: numbers are dense, chunks stay small."""
    rows = [(None, "a b c", "en", "x")] * 300 + [(i // 2, "a b c", "en", "x") for i in range(500)] + [(5, "a b c", "en", None)] * 9
    scratch = Scratch(spark, "test")
    sizes = scratch.save(documents(rows).repartition(7).selectExpr("doc_id", "source", "3L AS size", "spark_partition_id() AS part"))
    got = defaultdict(list)
    for r in mixing.with_copies(scratch, sizes).collect():
        got[r.doc_id, r.source].append(r["copy"])
    assert sum(map(len, got.values())) == len(rows) and len(got[None, "x"]) == 300
    assert all(sorted(v) == list(range(len(v))) for v in got.values())

    monkeypatch.setattr(mixing, "CHUNK", 16)
    saved = []
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df: saved.append(save(self, df)) or saved[-1])
    mixed = mixing.mix(documents(rows))
    longest = max(r.n for df in saved if "done" in df.columns for r in df.selectExpr("size(done) AS n").collect())
    assert longest < 16 * 4
    taken = [tuple(r) for r in mixed.select("source_size", "taken", "target").collect()]
    for size in {t[0] for t in taken}:
        assert abs(sum(t[1] for t in taken if t[0] == size) - next(t[2] for t in taken if t[0] == size)) <= 6
    assert rows_of(mixing.mix(documents(rows).repartition(11))) == rows_of(mixed)


def test_very_long_texts_and_clashing_columns(spark, documents):
    rows = [(1, "w " * 200_000, "en", "x"), (2, "w " * 150, "en", "x"), (3, "w " * 150, "en", "y")]
    plain = rows_of(mixing.mix(documents(rows)))
    assert {r[1] for r in plain} == {200_000, 150}
    extra = documents(rows).selectExpr("*", *[f"'z' AS {c}" for c in ("key", "copy", "size", "part", "target", "taken", "prob", "n", "unit")])
    assert rows_of(mixing.mix(extra)) == plain


def test_word_counts_and_empty_tables(spark, documents):
    rows = [(1, "a  b\tc\x0bd\x0ce\r\nf"), (2, " lead and trail "), (3, ""), (4, None), (5, "é ü x")]
    got = {r.doc_id: r["size_"] for r in documents(rows).select("doc_id", mixing.n_words("text").alias("size_")).collect()}
    assert got == {1: 6, 2: 3, 3: 0, 4: 0, 5: 2}
    assert mixing.mix(documents([])).collect() == []
    assert [r.taken for r in mixing.mix(documents([(1, None), (2, "")])).collect()] == [0, 0]
