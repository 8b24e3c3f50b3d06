"""SimHash: fingerprints by hand, links and components against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import simhash
from riskengine.llm.common import Scratch, components


def by_hand(text, shingle=4):
    ws = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    grams = [b" ".join(ws[i:i + shingle]) for i in range(max(1, len(ws) - shingle + 1))] if ws else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest_reachable(fps, ids, d=4):
    """Component ids over all pairs, by brute force."""
    best = list(ids)
    while True:
        new = [min([best[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= d and best[j] is not None],
                   default=None) for i in range(len(fps))]
        if new == best:
            return best
        best = new


TEXT = "One two three four five six seven eight nine ten eleven twelve. " * 6


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "A b c", "a\x0bB\x0cc d", TEXT, "é ß Ünïcode wörds und mehr davon",
                                  "x " * 70_000])
def test_fingerprint(text):
    got = simhash.fingerprint(None if text is None else text.encode())
    assert got % (1 << 64) == by_hand(text)


def clusters(seed, n=60, around=12):
    rnd = random.Random(seed)
    out = set()
    for _ in range(n):
        base = rnd.getrandbits(64)
        out.add(base)
        for _ in range(rnd.choice([0, 2, around])):
            x = base
            for _ in range(rnd.randint(1, 6)):
                x ^= 1 << rnd.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket_rows,task_rows", [(4096, 400_000), (4, 300)])
def test_links_keep_every_component(spark, monkeypatch, seed, bucket_rows, task_rows):
    """With coarse buckets, and with fine ones cut over many tasks."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(simhash, "TASK_ROWS", task_rows)
    monkeypatch.setattr(simhash, "PIECE", 16)
    fps = np.array(clusters(seed), np.uint64)
    signed = fps.view(np.int64).tolist()
    scratch = Scratch(spark, "test")
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = {r.node: r.root for r in components(scratch, simhash.links(scratch, df)).collect()}
    want = smallest_reachable([int(x) for x in fps], signed)
    assert [root.get(x, x) for x in signed] == want


def test_tree_skips_joined_groups_but_loses_no_link():
    """A dense cloud of near copies: thousands of links, one component."""
    rnd = np.random.default_rng(3)
    base = np.uint64(0x0123456789ABCDEF)
    flips = np.unique(np.bitwise_or.reduce(np.uint64(1) << rnd.integers(0, 64, (3000, 2)).astype(np.uint64), axis=1))
    fps = base ^ flips
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    assert set(simhash.Tree(fps, np.zeros(len(fps), int)).links(4)) == {0}


def test_near_duplicates_of_rows(spark, documents):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(5, TEXT), (9, TEXT.upper()), (9, TEXT), (7, None), (8, ""), (6, " "), (4, long), (3, long + " tail"),
            (None, long), (2, "quite different words stand here alone"), (None, "another text without an id at all")]
    got = sorted(simhash.near_duplicates(documents(rows)).collect(), key=str)
    fps = [by_hand(t) for _, t in rows]
    want = smallest_reachable(fps, [i for i, _ in rows])
    assert sorted(map(str, [(r.doc_id, r.fingerprint, r.component_id) for r in got])) == sorted(
        map(str, [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, want)]))


def test_keep_one_of_each_group(spark, documents):
    rows = [(5, TEXT), (9, TEXT), (5, TEXT), (None, TEXT), (7, None), (8, ""), (2, "quite different words stand here alone"),
            (None, "another text without an id"), (None, "another text without an id")]
    df = documents(rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(str, [(r.doc_id, r.text) for r in kept.collect()])) == sorted(
        map(str, [(5, TEXT), (7, None), (2, rows[6][1]), (None, rows[7][1])]))


def test_empty_table(spark, documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_one(documents([])).collect() == []


def test_bits_of_exactly_half_the_shingles_are_zero():
    both = [xxhash.xxh64_intdigest(x, 42) for x in (b"a b c d", b"b c d e")]
    assert simhash.fingerprint(b"a b c d e") & (1 << 64) - 1 == both[0] & both[1]
