"""Toxicity: gradients, held-out accuracy on planted words, thresholds and defined cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm import toxicity
from riskengine.llm.queries import op4_toxicity

LABELS = "doc_id long, quality int, toxic int, o int, y int"


def planted(n, seed=1):
    """English-like and German-like texts; those with a bad word (one list a language) are toxic."""
    rnd = random.Random(seed)
    syll = {"en": "th er on an re he in ed nd ha at en es of or".split(), "de": "der ung ein sch ich ver ge eit ber auf".split()}
    bad = {"en": ["idiot", "trash", "moron"], "de": ["lumpen", "depp", "gauner"]}
    docs, labels = [], []
    for i in range(n):
        lang = rnd.choice(["en", "de"])
        ws = ["".join(rnd.choice(syll[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randrange(5, 80))]
        y = int(rnd.random() < 0.2)
        for _ in range(y * rnd.randint(1, 3)):
            ws[rnd.randrange(len(ws))] = rnd.choice(bad[lang])
        docs.append((i, " ".join(ws), lang))
        labels.append((i, 1, y, 7, 7))
    return docs, labels


def test_training_lowers_the_loss():
    """Filters, layer and embeddings are trained together."""
    rnd = np.random.default_rng(1)
    net = toxicity.Network(list(range(50)))
    texts = [rnd.integers(0, 51, (n, 3)) for n in (1, 4, 30, 9)] * 8
    y = np.array([0, 1, 0, 1] * 8, np.float32)
    loss = lambda: np.mean([np.logaddexp(0, -(2 * t - 1) * net.logit(x)) for x, t in zip(texts, y)])
    before = loss()
    net.train(texts, y)
    assert loss() < 0.2 * before


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300, 20_000])
def test_forward_pass_against_a_plain_twin(n):
    """Every filter at every place of the text, word by word; the text ends in zero vectors."""
    rnd = np.random.default_rng(n)
    net = toxicity.Network(list(range(30)))
    net.embed[1:] = rnd.normal(0, 0.3, (30, toxicity.DIM))
    net.bias[:] = rnd.normal(0, 0.3, net.bias.shape)
    net.base = np.float32(0.25)
    rows = rnd.integers(0, 31, (n, 3))
    vectors = [sum((net.embed[f].astype(float) for f in word), np.zeros(toxicity.DIM)) for word in rows] + [np.zeros(toxicity.DIM)] * toxicity.PAD
    want, out = 0.25, iter(net.out.tolist())
    for k, width in enumerate(toxicity.WIDTHS):
        places = range(n + 1)  # from each word, and from the end
        spans = np.array([np.concatenate(vectors[i:i + width]) for i in places if i + width <= len(vectors)])
        for f in range(toxicity.FILTERS):
            response = spans @ net.filters[k][:, :, f].astype(float).ravel()
            want += max(0.0, response.max() + float(net.bias[k, f])) * next(out)
    assert net.logit(rows) == pytest.approx(want, abs=1e-3)


def test_word_vectors_against_word_by_word(monkeypatch):
    """Words are split, hashed and looked up together as one at a time, in slices of any size."""
    rnd = random.Random(3)
    words = [bytes(rnd.choices([*range(97, 123), *range(48, 58), *range(128, 256)], k=n)) for n in range(1, 40) for _ in range(20)]
    distinct, at, ends = toxicity.numbered([b" ".join(words), None, b"", b"., ", words[0] + b"-" + words[1].upper()])
    assert toxicity.all_features(distinct).tolist() == [list(toxicity.features(w)) for w in distinct.to_pylist()]
    assert ends.tolist() == [780, 780, 780, 780, 782] and [distinct[i].as_py() for i in at[:780].tolist()] == words
    net = toxicity.Network(np.unique([toxicity.features(w) for w in words[::2]]))
    net.start()
    texts = [None, b"", b" ", words[0], b".".join(words[1:3]), None, *(b" ".join(rnd.choices(words, k=n)) for n in (1, 7, 300)), b"x" * 50, b""]
    for size in (1, 500, 1 << 21):
        monkeypatch.setattr(toxicity, "SLICE", size)
        got = list(toxicity.word_vectors(net, texts))
        assert len(got) == len(texts) and not list(toxicity.word_vectors(net, []))
        for t, v in zip(texts, got):
            ids = np.array([toxicity.features(w) for w in toxicity.words(t, toxicity.ALNUM)], np.int32).reshape(-1, 3)
            assert v.shape == (len(ids), toxicity.DIM) and (v == net.vectors(net.rows(ids))).all()
    assert [v.shape for v in toxicity.word_vectors(toxicity.Network([]), [None, b"a b"])] == [(0, toxicity.DIM), (2, toxicity.DIM)]
    assert [v.shape for v in toxicity.word_vectors(net, [None])] == [(0, toxicity.DIM)]


def test_a_word_is_looked_up_once_for_many_texts(spark, documents, monkeypatch):
    """The scoring pass hashes the distinct words of its texts, not each text's."""
    net, seen = toxicity.Network([]), []
    rows = net.rows
    net.rows = lambda ids: seen.append(len(ids)) or rows(ids)
    assert len(list(toxicity.word_vectors(net, [b"some few words " * 9] * 200))) == 200 and sum(seen) == 3


def test_held_out_accuracy_and_thresholds(spark, documents):
    docs, labels = planted(1500)
    df, lab = documents(docs), spark.createDataFrame(labels, LABELS)
    net, lang = toxicity.learn(df.where("doc_id % 3 <> 1"), lab)
    assert set(net.cuts) == {None, "de", "en"}
    truth = {x[0]: x[2] for x in labels}
    got = {r.doc_id: r.toxicity for r in toxicity.score(df, net, lang).collect()}
    out = [(truth[i], s >= toxicity.CUT) for i, s in got.items() if i % 3 == 1]
    assert sum(a == b for a, b in out) >= 0.97 * len(out)
    assert all(0 <= s <= 1 for s in got.values())


def test_best_cut_is_the_middle_of_the_best_range():
    assert toxicity.best_cut(np.array([0.0, 1.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 2.0
    assert toxicity.best_cut(np.array([0.0, 5.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 1.5


def test_query_columns(spark, documents, tmp_path):
    docs, labels = planted(120, seed=2)
    docs += [(1000, None, "en"), (1001, "", "en"), (1002, "idiot " * 30_000, "en"), (1000, None, "en"), (None, "idiot", None)]
    documents(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels + [(5, 1, None, 0, 0), (9999, 1, 1, 0, 0), (1000, 1, 1, 0, 0)], LABELS).write.parquet(
        f"{tmp_path}/labels.parquet")
    got = op4_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(docs)
    for r in got:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(1, 1, 1, 0, 0)], 1.0), ([(1, 1, 0, 0, 0)], 0.0)])
def test_without_both_classes(spark, documents, labels, want):
    df = documents([(1, "some words"), (2, None)])
    fitted = toxicity.learn(df, spark.createDataFrame(labels, LABELS))
    assert [r.toxicity for r in toxicity.score(df, *fitted).collect()] == [want, want]
    assert toxicity.score(documents([]), *fitted).collect() == []


def test_every_labelled_row_is_learned_from(spark, documents, monkeypatch):
    """Words that two texts alone share are known for all 3,250 such pairs, in one chunk and in several."""
    docs = [(i, f"pair{i // 2:05d}") for i in range(6500)]
    df, lab = documents(docs), spark.createDataFrame([(i, 1, int(i % 10 < 4), 7, 7) for i in range(6500)], LABELS)
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    for rows in (6500, 1500):
        monkeypatch.setattr(toxicity, "CHUNK_ROWS", rows)
        net, _ = toxicity.learn(df, lab)
        assert net.rows(np.array([toxicity.features(f"pair{i:05d}".encode())[0] for i in range(3250)])).all()


def test_training_in_chunks(spark, documents, monkeypatch):
    """Chunks that meet in means tell held-out texts as well as one does; features may share rows."""
    docs, labels = planted(1500)
    df, lab = documents(docs), spark.createDataFrame(labels, LABELS)
    monkeypatch.setattr(toxicity, "CHUNK_ROWS", 400)
    monkeypatch.setattr(toxicity, "MOST", 1 << 10)
    net, lang = toxicity.learn(df.where("doc_id % 3 <> 1"), lab)
    assert net.shift == 14 and len(net.known) <= 1 << 10 and set(net.cuts) == {None, "de", "en"}
    truth = {x[0]: x[2] for x in labels}
    out = [(truth[r.doc_id], r.toxicity >= toxicity.CUT) for r in toxicity.score(df, net, lang).collect() if r.doc_id % 3 == 1]
    assert sum(a == b for a, b in out) >= 0.95 * len(out)


def test_best_cuts_against_one_process(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["en", "de", None]), y + rnd.gauss(0, 1), y) for y in (int(rnd.random() < 0.3) for _ in range(700))]
    rows += [("one", 0.5, 1), ("one", 1.5, 1), ("no", 0.25, 0)]
    got = toxicity.best_cuts(toxicity.Scratch(spark, "cuts"), spark.createDataFrame(
        [r for r in rows if r[0] is not None], "lang string, v double, y long"))
    rows = [r for r in rows if r[0] is not None]
    assert set(got) == {None, "en", "de", "one", "no"}
    for x, (cut, pos, neg) in got.items():
        own = [r for r in rows if x in (None, r[0])]
        y = np.array([r[2] for r in own])
        assert (pos, neg) == (y.sum(), (1 - y).sum())
        assert cut == pytest.approx(toxicity.best_cut(np.array([r[1] for r in own]), y))


@pytest.mark.parametrize("text", ["", "a word"])
def test_two_equal_texts_of_both_labels(spark, documents, text):
    df = documents([(1, text), (2, text), (2, text)])
    fitted = toxicity.learn(df, spark.createDataFrame([(1, 1, 1, 0, 0), (2, 1, 0, 0, 0), (2, 1, 0, 0, 0)], LABELS))
    assert all(0 <= r.toxicity <= 1 for r in toxicity.score(df, *fitted).collect())
