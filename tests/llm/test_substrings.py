"""Substring dedup against windows by brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import substrings
from riskengine.llm.common import Scratch, marked


def by_hand(rows, length=50):
    big = 1 << 62
    split = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), ws in zip(rows, split):
        for s in range(len(ws) - length + 1):
            k = tuple(ws[s:s + length])
            first[k] = min(first.get(k, big), big if i is None else i)
    out = []
    for (i, _), ws in zip(rows, split):
        gone = set()
        for s in range(len(ws) - length + 1):
            if first[tuple(ws[s:s + length])] < (big if i is None else i):
                gone.update(range(s, s + length))
        kept = b" ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda n: [rnd.choice("abcdefghij") * rnd.randint(1, 3) + str(rnd.randrange(300)) for _ in range(n)]
    shared = [word(n) for n in (49, 50, 51, 80, 200, 120)]
    rows = []
    for i in range(60):
        ws = word(rnd.randrange(0, 150))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(ws) + 1)
            ws[at:at] = rnd.choice(shared)
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(ws)))
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 5)]                 # exact copies
    rows += [(200, "again " * 400), (201, "again " * 120), (202, None), (203, ""), (204, " \n "), (None, rows[7][1])]
    rows += [(20, rows[20][1]), (20, rows[21][1])]                           # a repeated row, a repeated id
    return rows


@pytest.mark.parametrize("seed,group", [(1, 20_000), (2, 30), (3, 0)])
def test_repeats_as_by_brute_force(spark, documents, monkeypatch, seed, group):
    """All groups as subtrees, some, and none (each prefix extended to the whole window)."""
    monkeypatch.setattr(substrings, "GROUP_SUFFIXES", group)
    rows = corpus(seed)
    want = by_hand(rows)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(documents(rows)).collect()]
    assert sorted(map(str, got)) == sorted(str(w[:4]) for w in want)


def test_a_common_passage_is_dealt_over_rows_of_its_node(spark, documents, monkeypatch):
    """A third of all windows share one prefix; each still gets its least document, few of them a row."""
    monkeypatch.setattr(substrings, "SPREAD", 20)
    n = 1500
    windows = spark.createDataFrame(
        [(i % 5, str(i).encode(), i % 7, (b"hot" if i % 3 == 0 else b"warm" if i % 3 == 1 and i < 100 else str(i % 400).encode()), n - i, n)
         for i in range(n)], "anchor long, piece binary, off int, prefix binary, first_doc long, last_doc long")
    least = {}
    rows = windows.collect()
    for r in rows:
        least[bytes(r.prefix)] = min(least.get(bytes(r.prefix), n), r.first_doc)
    told = substrings._with_least(Scratch(spark, "test"), windows)
    got = sorted((bytes(r.piece), r.off, bytes(r.prefix), r.least) for r in told.collect())
    assert got == sorted((bytes(r.piece), r.off, bytes(r.prefix), least[bytes(r.prefix)]) for r in rows)

    monkeypatch.setattr(substrings, "SPREAD", 2)
    monkeypatch.setattr(substrings, "GROUP_SUFFIXES", 0)
    texts = corpus(5)
    made = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(documents(texts)).collect()]
    assert sorted(map(str, made)) == sorted(str(w[:4]) for w in by_hand(texts))


@pytest.mark.parametrize("words_at_once", [1_500_000, 200])
def test_cleaned_texts(spark, documents, monkeypatch, words_at_once):
    monkeypatch.setattr(substrings, "TREE_WORDS", words_at_once)
    rows = corpus(4)
    df = documents(rows)
    got = substrings.cleaned_texts(df)
    assert got.columns == df.columns
    want = [(i, kept if gone else text) for (i, text), (_, _, gone, _, kept) in zip(rows, by_hand(rows))]
    assert sorted(map(str, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(str, want))


def test_other_lengths_and_a_very_long_text(spark, documents):
    rnd = random.Random(9)
    long = " ".join(str(rnd.randrange(50_000)) for _ in range(60_000))
    rows = [(1, long), (2, "x " + " ".join(long.split()[30_000:30_012]) + " y"), (3, long)]
    for length in (3, 12, 13):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                     for r in substrings.remove_repeats(documents(rows), length=length).collect())
        assert got == [w[:4] for w in by_hand(rows, length)]


def test_empty_table(spark, documents):
    assert substrings.remove_repeats(documents([])).collect() == []
    assert substrings.cleaned_texts(documents([])).collect() == []


def test_rows_that_are_no_key_are_told_apart(spark):
    """Every key is marked, few others are; nulls and equal rows too, and without keys none."""
    rows = spark.range(20_000).selectExpr("nullif(id % 10000, 0L) AS a", "id % 10000 % 7 AS b", "id AS c")
    keys = rows.where("coalesce(a, 0) % 100 = 0").select("a", "b").distinct()
    got = marked(rows, ["a", "b"], keys)
    assert got.columns == ["a", "b", "c", "_maybe"] and got.count() == 20_000
    assert got.where("coalesce(a, 0) % 100 = 0").where("_maybe").count() == 200
    assert got.where("_maybe").count() < 2000
    assert marked(rows, ["a", "b"], keys.limit(0)).where("_maybe").count() == 0


def test_only_texts_with_repeats_are_moved(spark, documents):
    """Of 2,000 texts two share a passage; they alone are joined with their spans, by a shuffle."""
    rnd = random.Random(4)
    rows = [(i, " ".join(str(rnd.randrange(10 ** 9)) for _ in range(60))) for i in range(2000)]
    rows[1500] = (1500, f"before {rows[3][1]}  after")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = substrings.cleaned_texts(documents(rows).repartition(4))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.startswith("Union") and plan.count("Join LeftOuter, ((doc") == 1
        got = {r.doc_id: r.text for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: "before after" if i == 1500 else t for i, t in rows}
    repeats = substrings.repeated_windows(Scratch(spark, "test"), documents(rows))[1]
    assert [r.doc for r in repeats.collect()] == [1500]
