"""Decontamination against windows by brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import decontam
from riskengine.llm.common import ALNUM, words


def by_hand(rows, items, length=10):
    win = []
    for item, t in items:
        ws = words((t or "").encode(), ALNUM)
        m = min(length, len(ws))
        win += [(item, m, tuple(ws[s:s + m])) for s in range(len(ws) - m + 1)] if ws else []
    out = []
    for i, t in rows:
        ws = words((t or "").encode(), ALNUM)
        hit, found = set(), set()
        for item, m, k in win:
            for s in range(len(ws) - m + 1):
                if tuple(ws[s:s + m]) == k:
                    hit.update(range(s, s + m))
                    if item is not None:
                        found.add(str(item))
        out.append((i, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def cases(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("one two three four five six seven eight nine ten Elf zwölf".split())
    items = [(i, " ".join(word() for _ in range(rnd.choice([10, 11, 15, 40])))) for i in range(12)]
    items += [(100, items[0][1]), (2, items[1][1]), (None, items[3][1]), (7, None), (8, " - "), (9, "one two, three"), (10, "Elf")]
    rows = []
    for i in range(50):
        ws = [rnd.choice(["filler%d" % rnd.randrange(40), "one"]) for _ in range(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(3)):
            src = (items[rnd.randrange(12)][1]).split()
            lo = rnd.randrange(len(src))
            at = rnd.randrange(len(ws) + 1)
            ws[at:at] = src[lo:lo + rnd.choice([5, 9, 10, 30])]
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(ws).upper() if i % 3 else " ".join(ws)))
    return rows + [(200, None), (201, ""), (None, items[2][1]), (5, rows[5][1]), (5, items[4][1]), (202, (items[5][1] + " ") * 300)], items


@pytest.mark.parametrize("seed,short", [(1, False), (2, True)])
def test_hits_as_by_brute_force(spark, documents, seed, short):
    rows, items = cases(seed)
    items = items if short else [x for x in items if x[0] not in (9, 10)]
    bench = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, `window` int, size int")
    got = decontam.contamination(documents(rows), bench).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, by_hand(rows, items)))
    clean = decontam.without_contaminated(documents(rows), bench)
    want = sorted(str((i, t)) for (i, t), h in zip(rows, by_hand(rows, items)) if not h[5])
    assert sorted(str((r.doc_id, r.text)) for r in clean.collect()) == want and clean.columns == documents([]).columns


def test_rolling_hashes_select_the_least_gram(spark):
    """Each window's print is the least of its k-grams, whatever the window's length."""
    ws = [f"w{i % 7}" for i in range(30)]
    df = spark.createDataFrame([(ws,), (ws[:9],), ([],)], "w array<string>")
    for m in (1, 3, 5, 10):
        k = min(decontam.GRAM, m)
        got = [r.f for r in decontam.with_least_grams(df, "w", m, "f").collect()]
        assert [len(f) for f in got] == [max(0, n - m + 1) for n in (30, 9, 0)]
        grams = decontam.with_least_grams(df, "w", k, "f").first().f
        assert got[0] == [min(grams[s:s + m - k + 1]) for s in range(30 - m + 1)]


def test_words_are_lower_cased_and_split(spark, documents):
    df = documents([(1, "A-b_C1 Äö, x\x7fy z"), (2, None)]).select("doc_id", decontam.alnum_words("text").alias("ws"))
    got = {r.doc_id: r.ws for r in df.collect()}
    assert got == {1: ["a", "b", "c1", "Äö", "x", "y z"], 2: []}


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contamination(documents([]), some).collect() == []
    assert [tuple(r)[1:4] for r in decontam.contamination(documents([(1, "a b c")]), none).collect()] == [(3, 0, 0)]
    assert decontam.without_contaminated(documents([(1, "a b c"), (2, "a b")]), some).select(F.max("doc_id")).first()[0] == 2
