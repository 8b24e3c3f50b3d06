"""Hard negatives against scoring every row for every anchor."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskengine.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id long, q int, dim int, anchor int, score int, part int, _i int, rank int"


def by_hand(rows, every=5, n_positives=5, n_negatives=3, low=50, high=95, scale=256):
    kept = []
    for i, v, lab in rows:
        if lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(scale * x) for x in v]
        if sum(x * x for x in q) < 2 ** 62:
            kept.append((i, q, lab))
    out = []
    for at, (i, q, lab) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, w, strict=True)), math.inf if j is None else j, j, m)
                         for k, (j, w, m) in enumerate(kept) if k != at and len(w) == len(q)), key=lambda x: x[:2])
        for s, _, p, _ in [x for x in scored if x[3] == lab][:n_positives]:
            fits = [x for x in scored if x[3] != lab and low * -s <= 100 * -x[0] <= high * -s][:n_negatives]
            out += [(i, p, r, x[2], -s, -x[0]) for r, x in enumerate(fits, 1)]
    return sorted(out, key=repr)


def run(spark, rows, every=5, **kw):
    table = spark.createDataFrame([(*r, *range(8)) for r in rows], SCHEMA)
    return sorted(map(tuple, negatives.hard_negatives(table, F.col("vec_id") % every == 0, **kw).collect()), key=repr)


def vectors(seed, n, dim=6, labels=3):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        c, spread = rnd.choice(centres), rnd.choice([0.05, 0.4, 2])
        rows.append((i, [x + rnd.gauss(0, spread) for x in c], rnd.choices(range(labels), [6, 2, 1][:labels])[0]))
    return rows


@pytest.mark.parametrize("seed,dim,block,chunk,shard,slot,group", [(1, 6, 256, 512, 2048, 1 << 17, 1 << 17), (2, 3, 4, 5, 20, 60, 7), (3, 12, 1, 3, 7, 50, 3)])
def test_equal_to_brute_force(spark, monkeypatch, seed, dim, block, chunk, shard, slot, group):
    for k, v in {"BLOCK": block, "CHUNK": chunk, "SHARD": shard, "SLOT": slot, "GROUP": group}.items():
        monkeypatch.setattr(negatives, k, v)
    rows = vectors(seed, 220, dim)
    got = run(spark, rows)
    assert got == by_hand(rows) and got


def test_awkward_rows(spark):
    rows = vectors(4, 60, 4)
    far = [2.0 ** 30] * 4
    rows += [(None, rows[0][1], rows[0][2]), (None, rows[5][1], 2), (100, None, 1), (105, [1.0, None, 0.0, 1.0], 1), (110, [1.0, math.nan, 0.0, 1.0], 1),
             (115, [math.inf, 0.0, 0.0, 1.0], 1), (120, [1.0] * 4, None), (125, [0.0] * 4, 1), (130, [], 1), (135, [], 1), (140, [], 0), (145, [0.5], 0), (150, [0.9], 0),
             (155, [0.3], 1), rows[10], rows[10], rows[11], (160, [1.0] * 4, 0), (160, [1.0] * 4, 0), (161, [1.0] * 4, 0), (162, [0.9] * 4, 1), (163, [0.9] * 4, 1),
             (165, far, 1), (166, far, 0), (170, [-x for x in far], 0), (175, [2.0 ** 55, 0.0, 0.0, 0.0], 1)]
    got = run(spark, rows)
    assert got == by_hand(rows)
    assert any(r[0] == 165 for r in got) is any(r[0] == 165 for r in by_hand(rows))


def test_bands_of_integers():
    s = np.arange(-2000, 2001, dtype=np.int64)
    lo, hi = negatives.bands(s, 50, 95)
    for x, a, z in zip(s.tolist(), lo.tolist(), hi.tolist(), strict=True):
        assert a == math.ceil(50 * x / 100) and z == math.floor(95 * x / 100) or (50 * x <= 100 * a < 50 * x + 100 and 95 * x - 100 < 100 * z <= 95 * x)
    big = np.array([(1 << 62) - 1, -(1 << 62)], np.int64)
    lo, hi = negatives.bands(big, 50, 95)
    for x, a, z in zip(big.tolist(), lo.tolist(), hi.tolist(), strict=True):
        assert (a, z) == (-(-50 * x // 100), 95 * x // 100)


def test_walks_end_early_and_lose_nothing():
    """Of two far clusters, members of one never score the other's rows."""
    rnd = np.random.default_rng(7)
    near = (1000 * np.eye(1, 8) + rnd.normal(0, 20, (2000, 8))).astype(np.int64)
    x = np.concatenate([near, -near])
    slot = negatives.Candidates(np.arange(len(x)), np.zeros(len(x), np.int64), x)
    shared, found = negatives.SharedList(near[:50], slot), [negatives.Best(6) for _ in range(50)]

    def take(members, rows, scores):
        for i, m in enumerate(members):
            found[m].add(scores[i], rows)
        return np.array([found[m].floor() for m in members])

    assert shared.walk(take) <= 50 * 2048 < 50 * len(x)
    scores = near[:50] @ x.T
    for i, b in enumerate(found):
        assert b.ids.tolist() == sorted(range(len(x)), key=lambda j: (-scores[i, j], j))[:6]


def test_empty_tables_and_no_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [0.7], 2)]) == []
    assert run(spark, [(5, [1.0], 1), (2, [0.7], 2)]) == []
    rows = [(5, [1.0], 1), (1, [1.0], 1), (2, [0.7], 2)]
    assert run(spark, rows) == by_hand(rows) == [(5, 1, 1, 2, 65536, 45824)]
