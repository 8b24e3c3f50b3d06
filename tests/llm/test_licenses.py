"""License scans against word-by-word search and plain containment."""

from __future__ import annotations

import random

import pytest

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import licenses
from riskengine.llm.common import ALNUM, words


def base_by_hand(text):
    ws = words((text or "").encode(), ALNUM)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.encode().split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def texts():
    rnd = random.Random(1)
    filler = ["lorem", "mit", "license", "by", "cc", "gnu", "general", "public", "apache", "the", "Ünder"]
    out = [None, "", " -- ", "MIT License", "Apache\nLicense apache license", "cc-by CC BY, cc.by", "GNU General Public", "x" * 50_000,
           "The MIT LICENSE. " * 5000, licenses.NOTICES[0][1], licenses.NOTICES[3][1].upper(), "word " * 70 + licenses.NOTICES[1][1]]
    out += [" ".join(rnd.choice(filler) for _ in range(rnd.randrange(1, 700))) for _ in range(60)]
    return out


def test_base_places_and_labels(spark, documents):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in licenses.summary(licenses.scan(documents(rows), licenses.templates())).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("stride", [3, 64])
def test_every_matching_block_is_found(spark, documents, monkeypatch, stride):
    """Blocks and templates by plain containment, without order or filters."""
    monkeypatch.setattr(licenses, "LEAST_STRIDE", stride)
    notices = [("ab", "alpha beta gamma delta epsilon"), ("c", "alpha gamma kappa"), ("none", "..."), ("r", "beta beta iota")]
    of = licenses.templates({}, notices, 0.6)
    assert [t.label for t in of] == ["ab", "c", "r"]
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice("alpha beta gamma delta epsilon iota kappa mu nu xi pi rho".split())
                         for _ in range(rnd.randrange(0, 60)))) for i in range(40)]
    got = {r.doc_id: {(m.label, m.block, round(m.score, 9)) for m in r.matches}
           for r in licenses.scan(documents(rows), of).collect()}
    step = max(stride, 5)
    for i, t in rows:
        ws, want = t.split(), set()
        for b in range(max(1, -(-len(ws) // step) - 1)):
            block = set(ws[b * step:(b + 2) * step])
            for label, text in notices:
                words_ = set(text.replace(".", "").split())
                if words_ and len(words_ & block) >= 0.6 * len(words_) - 1e-9:
                    want.add((label, b, round(len(words_ & block) / len(words_), 9)))
        assert got[i] == want


def test_notices_need_their_share_of_words(spark, documents):
    notice = licenses.NOTICES[0][1].split()
    rows = [(1, " ".join(notice)), (2, " ".join(notice[: len(notice) // 3])), (3, "plain words " * 100)]
    got = {r.doc_id: r.labels for r in licenses.summary(licenses.scan(documents(rows), licenses.templates())).collect()}
    assert got == {1: "mit", 2: "", 3: ""}


def test_empty_table_and_repeated_rows(spark, documents):
    assert licenses.scan(documents([]), licenses.templates()).collect() == []
    got = licenses.summary(licenses.scan(documents([(1, "mit license"), (1, "mit license"), (None, "cc by")]), licenses.templates()))
    assert sorted(map(str, [(r.doc_id, r.base_labels) for r in got.collect()])) == ["(1, 'mit')", "(1, 'mit')", "(None, 'cc-by')"]
