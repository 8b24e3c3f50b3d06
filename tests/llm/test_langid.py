"""Language identification: codes, decoding, held-out accuracy and defined cases."""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import langid
from riskengine.llm.common import table
from riskengine.llm.queries import op3_language_id


@pytest.mark.parametrize("k", [2, 4, 7, 12, 40])
def test_codewords_are_distinct_and_bits_split(k):
    code = langid.codewords(k)
    assert len({tuple(r) for r in code}) == k and set(np.unique(code)) <= {-1.0, 1.0}
    assert (np.abs(code.sum(axis=0)) < k).all()
    if k <= langid.EXHAUSTIVE:
        assert code.shape[1] == 2 ** (k - 1) - 1


def test_decoding_corrects_wrong_bits():
    model = langid.Model(list("abcde"), np.ones((5, 1 << langid.BITS)))
    rnd = np.random.default_rng(1)
    for k, word in enumerate(model.code):
        wrong = rnd.choice(len(word), 3, replace=False)  # distance 8: three wrong bits are corrected
        margins = word * 2
        margins[wrong] *= -1
        model.margins = lambda _text, m=margins: m
        assert model.predict(b"text")[0] == "abcde"[k]
    model.margins = lambda _text: np.zeros(model.code.shape[1])
    assert model.predict(b"text")[2]                     # no bit tells: ambiguous


def test_ties_go_to_the_first_language_and_are_flagged():
    model = langid.Model(["b", "c", "d"], np.ones((3, 1 << langid.BITS)))
    assert model.predict(b"any text") == ("b", pytest.approx(1 / 3), True)


def test_gram_counts_ignore_case_and_layout():
    a, b = langid.gram_counts(b"Hello  World\n12"), langid.gram_counts(b"hello, world!")
    assert (a == b).all()
    text = " hello world ".encode()
    assert a.sum() == sum(len(text) - n + 1 for n in langid.ORDERS)


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in table(spark, SF_MID, "documents").select("doc_id", "text", "lang").collect()}
    got = op3_language_id(spark, SF_MID).collect()
    assert len(got) == len(docs) and set(got[0].asDict()) >= {"doc_id", "held_out", "lang_pred", "score"}
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in out) >= 0.97 * len(out)


def plain_grams(text):
    """Hashed 1-, 2- and 3-byte grams of a text's letters, by the byte."""
    kept = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    line = b" " + b" ".join(kept.split()) + b" "
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            yield ((int.from_bytes(line[i:i + n], "big") + (n << 28)) * 2654435761 % (1 << 32)) >> (32 - langid.BITS)


def test_whole_operator_against_a_plain_twin(spark):
    """Counts, bit classifiers, weights and decoding written out with dictionaries, for every document."""
    docs = [r for r in table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang").collect()]
    letters = lambda t: t is not None and any(c.isalpha() for c in t)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    rows = [(r.text, r.lang) for r in docs if not held(r.doc_id) and r.lang is not None]
    count, size = {}, 1 << langid.BITS
    for t, lang in rows:
        if letters(t):
            count.setdefault(lang, Counter()).update(plain_grams(t))
    names = sorted(count)
    assert 2 < len(names) <= langid.EXHAUSTIVE and len(rows) <= langid.SAMPLE  # every split is a bit, every row is weighed
    total = {x: sum(count[x].values()) + 0.5 * size for x in names}
    splits = [set(names[:1]) | {x for i, x in enumerate(names[1:]) if s >> i & 1} for s in range((1 << (len(names) - 1)) - 1)]

    def mean(languages, gram):
        return sum((count[x][gram] + 0.5) / total[x] for x in languages) / len(languages)

    @functools.cache
    def odds(gram):
        return [math.log(mean(on, gram)) - math.log(mean(set(names) - on, gram)) for on in splits]

    def margins(t):
        grams = list(plain_grams(t))
        return [sum(odds(g)[b] for g in grams) / math.sqrt(len(grams)) for b in range(len(splits))]

    right = {x: [] for x in names}
    for t, lang in rows:
        if letters(t):
            right[lang].append([(m > 0) == (lang in on) for m, on in zip(margins(t), splits, strict=True)])
    weight = {x: [sum(col) / len(right[x]) + 1e-3 for col in zip(*right[x], strict=True)] for x in names}
    want = {}
    for r in docs:
        if not letters(r.text):
            want[r.doc_id] = ("und", 0.0, True)
            continue
        m = margins(r.text)
        loss = {x: sum(w * math.log1p(math.exp(-(v if x in on else -v))) for w, v, on in zip(weight[x], m, splits, strict=True))
                / sum(weight[x]) for x in names}
        near = sorted(names, key=lambda x: (loss[x], x))
        want[r.doc_id] = (near[0], 1 / sum(math.exp(4 * (loss[near[0]] - loss[x])) for x in names), loss[near[1]] - loss[near[0]] < langid.GAP)
    got = {r.doc_id: r for r in op3_language_id(spark, SF_SMALL).collect()}
    assert {i: r.lang_pred for i, r in got.items()} == {i: w[0] for i, w in want.items()}
    assert all(got[i].score == pytest.approx(w[1], abs=1e-4) for i, w in want.items())
    model = langid.learn(table(spark, SF_SMALL, "documents").where((langid.fold("doc_id", 4) != 2)))
    flagged = {r.doc_id: r.language.ambiguous for r in langid.identify(table(spark, SF_SMALL, "documents"), model).collect()}
    assert flagged == {i: w[2] for i, w in want.items()}


def test_defined_cases(spark, documents):
    rows = [(1, "der die das und nicht " * 5, "de"), (2, "the and of to with " * 5, "en"), (3, None, "en"), (4, "123 456", "de"),
            (None, "der und die", None), (5, "the of the", "en"), (5, "the of the", "en"), (6, "", "de"), (7, "und die " * 30_000, "de")]
    df = documents(rows)
    model = langid.learn(df)
    assert model.languages == ["de", "en"]
    got = sorted(map(str, [(r.doc_id, r.language.lang) for r in langid.identify(df, model).collect()]))
    assert got == sorted(map(str, [(1, "de"), (2, "en"), (3, "und"), (4, "und"), (None, "de"), (5, "en"), (5, "en"), (6, "und"),
                                   (7, "de")]))


def test_few_languages_and_empty_tables(spark, documents):
    none = langid.learn(documents([]))
    assert none.predict(b"some text") == ("und", 0.0, True)
    one = langid.learn(documents([(1, "the words", "en")]))
    assert one.predict(b"whatever") == ("en", 1.0, False) and one.predict(b"12")[0] == "und"
    assert langid.identify(documents([]), none).collect() == []


def test_prediction_uses_the_text_alone(spark, documents):
    model = langid.learn(documents([(1, "der die das und " * 9, "de"), (2, "the and of to " * 9, "en")]))
    a = langid.identify(documents([(1, "the of", "de", "x"), (2, "the of", None, None)]), model).collect()
    assert a[0].language == a[1].language


def test_bit_weights_count_every_document(spark):
    """Shares of right answers over all 5,000 documents, one in five of them told wrongly."""
    texts = [("abc abc" if i % 5 else "xyz xyz", "en") for i in range(2500)] + [("xyz xyz", "de")] * 2500
    model = langid.learn(spark.createDataFrame(texts, "text string, lang string"))
    assert model.weights.tolist() == [[1.0], [1.0]]
    three = texts + [("mno mno" if i % 7 else "abc abc", "fr") for i in range(500)]
    model = langid.learn(spark.createDataFrame(three, "text string, lang string"))
    for k, lang in enumerate(model.languages):
        own = [t.encode() for t, x in three if x == lang]
        share = np.mean([model.margins(t) * model.code[k] > 0 for t in own], axis=0) + 1e-3
        assert model.weights[k] == pytest.approx(share / share.sum(), abs=1e-12)
