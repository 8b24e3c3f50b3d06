"""Spelling variants against comparing all words."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import spelling
from riskengine.llm.common import Scratch
from riskengine.llm.queries import LostLetter


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(rows, shortest=7, least=2, factor=10, lose=False):
    letters = set("abcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xC0, 0x100)}
    n = Counter()
    for i, t in rows:
        run = ""
        for ch in (t or "") + " ":
            ch = ch.lower() if "A" <= ch <= "Z" else ch
            if ch in letters:
                run += ch
                continue
            if lose and run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                n[run] += 1
            run = ""
    n = {w: c for w, c in n.items() if c >= least}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def variants_of(rnd, word, times):
    alphabet = "abcé"
    for _ in range(times):
        i = rnd.randrange(len(word) + 1)
        yield rnd.choice([word[:i] + word[i + 1:], word[:i] + rnd.choice(alphabet) + word[i:], word[:i] + rnd.choice(alphabet) + word[i + 1:]])


def texts(seed, n=40):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randrange(6, 14))) for _ in range(40)]
    words += [v for w in words for v in variants_of(rnd, w, 4)] + [v for v in variants_of(rnd, words[0], 30)]
    weights = [rnd.choice([1, 1, 1, 30, 900]) for _ in words]
    return [(i, rnd.choice([" ", ", ", "-", "9"]).join(rnd.choices(words, weights, k=150))) for i in range(n)]


@pytest.mark.parametrize("seed,grams,longest,shortest,lose", [(1, 20_000, 5, 7, True), (2, 60, 5, 4, False), (3, 300, 3, 5, False), (4, 1, 5, 7, False)])
def test_equal_to_comparing_all_words(spark, documents, monkeypatch, seed, grams, longest, shortest, lose):
    monkeypatch.setattr(spelling, "GRAMS", grams)
    monkeypatch.setattr(spelling, "LONGEST", longest)
    monkeypatch.setattr(spelling, "TASK_WORDS", 50)
    rows = texts(seed)
    want = by_hand(rows, shortest, lose=lose)
    assert got(spelling.variants(documents(rows), LostLetter() if lose else None, shortest=shortest)) == want
    assert sum(w[4] for w in want) > 20 and any(w[2] != w[0] for w in want)


@settings(max_examples=600, deadline=None)
@given(st.text("abé", min_size=4, max_size=14), st.sets(st.text("abé", min_size=3, max_size=6), max_size=60), st.integers(2, 6), st.data())
def test_every_edit_leaves_a_list(word, grams, most, data):
    """A word and the other one of any insertion or replacement stand in a list together."""
    known = frozenset(g[:k] for g in grams for k in range(3, len(g) + 1))
    i, ch, before = data.draw(st.integers(0, len(word))), data.draw(st.sampled_from("abéz")), spelling.LONGEST
    try:
        spelling.LONGEST = most
        own = spelling.merged_lists(word, known, len(word))
        for other in {word[:i] + ch + word[i:], word[:i] + ch + word[i + 1:] if i < len(word) else word}:
            assert any(x == y for x, y in zip(own, spelling.merged_lists(other, known, len(word)), strict=True))
    finally:
        spelling.LONGEST = before


@settings(max_examples=400, deadline=None)
@given(st.text("ab", min_size=4, max_size=14), st.sets(st.text("ab", min_size=3, max_size=6), max_size=60), st.integers(2, 6), st.data())
def test_bounds_on_affected_grams(word, grams, most, data):
    """Grams that an edit is said to leave are grams of the other word, with their side unchanged."""
    known = frozenset(g[:k] for g in grams for k in range(3, len(g) + 1))
    i, ch = data.draw(st.integers(0, len(word))), data.draw(st.sampled_from("abz"))
    edits = [(word[:i] + ch + word[i:], 1)]
    if i < len(word):
        edits += [(word[:i] + ch + word[i + 1:], 0), (word[:i] + word[i + 1:], -1)]
    for other, d in edits:
        places = {(p, e) for p, e, _, _ in spelling.lasting(other, known, most)}
        for p, e, after, before in spelling.lasting(word, known, most):
            if i >= after:
                assert (p, e) in places and other[:e] == word[:e]
            if i < before or (d == 1 and i == before):
                assert (p + d, e + d) in places and other[p + d:] == word[p:]


def test_long_chains_reach_the_last(spark):
    names = [f"w{i:02d}" for i in range(18)]
    table = spark.createDataFrame([(w, x) for w, x in zip(names, [*names[1:], None], strict=True)], "word string, form string")
    ends = spelling.roots(Scratch(spark, "test"), table).collect()
    assert len(ends) == 18 and {r.root for r in ends} == {names[-1]}


def test_awkward_rows(spark, documents):
    long = "abcdefgh " * 30_000 + "x" * 100_000 + " " + "x" * 100_000
    rows = [(1, None), (2, ""), (3, long), (None, "abcdefgi abcdefgi"), (5, "ABCDEFGI Éclairage éclairage"), (5, "ABCDEFGI Éclairage éclairage"),
            (6, "zzzzzzz1zzzzzzz"), (7, "abcdefgj abcdefgj"), (8, "abcdefg×hij abcdefg×hij"), (9, "abcdefgα abcdefgα Abcdefg")]
    assert got(spelling.variants(documents(rows))) == by_hand(rows)
    ties = [(1, "aaaaaaab " * 20 + "aaaaaaac " * 20 + "aaaaaaad " * 2)]
    assert ("aaaaaaad", "aaaaaaab", "aaaaaaab", 2, 2, 20) in got(spelling.variants(documents(ties)))
    assert got(spelling.variants(documents([]))) == []
    bad = spark.sql("SELECT 1L AS doc_id, CAST(X'61626364656667FF61626364656667' AS string) AS text")
    assert got(spelling.variants(bad)) == [("abcdefg", None, "abcdefg", 2, 0, None)]
    with pytest.raises(ValueError):
        spelling.variants(documents([]), shortest=3)


def test_lost_letters_follow_the_hash():
    lose = LostLetter()
    runs = [f"abcdefg{chr(97 + i)}é" for i in range(26)]
    for i in range(200):
        for r in runs:
            h = zlib.crc32(f"{i}:{r}".encode())
            want = r if h % 31 else r[:h % len(r)] + r[h % len(r) + 1:]
            assert lose(lose.start(str(i)), r) == want

