"""Language identification by error-correcting output codes over byte n-grams.

Each learned language has a codeword; each bit of the code is a binary classifier on hashed
n-grams (naive Bayes: the languages with that bit set against the others).  A text's bits are
decoded to the codeword of least weighted loss, a bit's weight for a language being how well
its classifier does on it.  The gap to the next codeword tells ambiguous texts.

N-gram counts cover every learning document: tasks count by language in numpy and a native
grouped sum merges them, so what reaches the driver is buckets x languages.  Bit weights are
measured on every learning document too.  Only the text enters a prediction.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with no learned
language all are ``und``; with one, all texts with letters get it; a null language is not
learned from; rows repeat freely; of equally near languages the first by code point is told, and
flagged; a very long text is counted whole, in one task, at linear cost; other columns are carried
as they are, but for one named as the result (``into``), which is replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Shared, utf8

BITS = 14          # hashed n-grams: 2 ** BITS buckets
ORDERS = (1, 2, 3)
SAMPLE = math.inf  # learning documents that bit weights are measured on: no bound
GAP = 0.35         # least gap of mean losses between the best two languages
EXHAUSTIVE = 7     # languages up to which every distinct split is a bit
UNKNOWN = "und"

#: ASCII letters in lower case and bytes from 0x80 stay; anything else is a space.
LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in LOWER)
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def gram_counts(text: bytes) -> np.ndarray:
    """Counts of a text's hashed byte n-grams."""
    a = np.frombuffer(b" " + b" ".join(text.translate(LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    gram, found = np.zeros(len(a), np.uint32), []
    for n in range(1, max(ORDERS) + 1):
        gram = (gram[:len(a) - n + 1] << np.uint32(8)) | a[n - 1:]
        if n in ORDERS:
            found.append(((gram + np.uint32(n << 28)) * np.uint32(2654435761)) >> np.uint32(32 - BITS))
    return np.bincount(np.concatenate(found), minlength=1 << BITS)


def codewords(k: int, seed: int = 3) -> np.ndarray:
    """``k`` codewords of +1 and -1: all distinct splits, or the best of seeded random codes."""
    if k < 2:
        return np.ones((k, 0))
    if k <= EXHAUSTIVE:
        splits = [[1] + [1 if (s >> i) & 1 else -1 for i in range(k - 1)] for s in range((1 << (k - 1)) - 1)]
        return np.array(splits, np.float64).reshape(-1, k).T
    rng, best = np.random.default_rng(seed), None
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (k, 10 * int(np.ceil(np.log2(k)))))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        near = (code @ code.T)[~np.eye(k, dtype=bool)].max()
        if best is None or near < best[0]:
            best = (near, code)
    return best[1]


class Model:
    """Languages, their codewords, the bits' n-gram weights and each bit's weight by language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        p = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        self.code = codewords(len(languages))
        on, off = self.code.T > 0, self.code.T < 0
        self.odds = (np.log(on @ p / on.sum(axis=1, keepdims=True))
                     - np.log(off @ p / off.sum(axis=1, keepdims=True))).T.astype(np.float32).astype(np.float64)
        self.weights = np.full_like(self.code, 1 / max(1, self.code.shape[1]))

    def margins(self, text: bytes) -> np.ndarray:
        counts = gram_counts(text)
        some = np.flatnonzero(counts)
        return (counts[some].astype(np.float64) @ self.odds[some]) / np.sqrt(counts.sum())

    def weigh(self, right: dict[str, tuple[int, list[int]]]) -> None:
        """Set each bit's weight for a language to its share of right answers on it.

        ``right``: a language's texts, and on how many of them each bit answers right.
        """
        for k, x in enumerate(self.languages):
            n, bits = right[x]
            self.weights[k] = np.array(bits) / n + 1e-3
        self.weights /= self.weights.sum(axis=1, keepdims=True)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, score and whether the two nearest codewords are too close to tell."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.weights * np.logaddexp(0, -self.code * self.margins(text))).sum(axis=1)
        best, second = np.argsort(loss, kind="stable")[:2]
        share = np.exp(4 * (loss[best] - loss))
        return self.languages[best], float(1 / share.sum()), bool(loss[second] - loss[best] < GAP)


def _count(batches):
    seen: dict[str, np.ndarray] = {}
    for b in batches:
        for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if has_letter(t):
                c = gram_counts(t)
                seen[lang] = seen[lang] + c if lang in seen else c
    for lang, c in seen.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())],
                                         ["lang", "gram", "n"])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit a model to all rows of ``docs`` with a language."""
    spark = docs.sparkSession
    rows = docs.where(F.col(lang_col).isNotNull()).select(utf8(docs, text_col), F.col(lang_col).cast("string").alias("lang"))
    total = rows.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = total.toArrow()  # buckets x languages at most
    languages = sorted(set(got.column("lang").to_pylist()))
    counts = np.zeros((len(languages), 1 << BITS))
    row = {x: i for i, x in enumerate(languages)}
    np.add.at(counts, ([row[x] for x in got.column("lang").to_pylist()], got.column("gram").to_numpy()),
              got.column("n").to_numpy())
    model = Model(languages, counts)
    if len(languages) > 1:
        shared = Shared(spark, model)

        def measure(batches):
            model, right = shared.value, {}
            at = {x: i for i, x in enumerate(model.languages)}
            for b in batches:
                for t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if has_letter(t):
                        n, bits = right.get(x, (0, 0))
                        right[x] = n + 1, bits + (model.margins(t) * model.code[at[x]] > 0)
            for x, (n, bits) in right.items():
                yield pa.RecordBatch.from_arrays([pa.array([x] * len(bits)), pa.array(range(len(bits)), pa.int32()), pa.array([n] * len(bits), pa.int64()),
                                                  pa.array(bits, pa.int64())], ["lang", "bit", "n", "good"])

        seen = rows.mapInArrow(measure, "lang string, bit int, n long, good long").groupBy("lang", "bit").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        right: dict[str, tuple[int, list[int]]] = {}
        for r in seen.orderBy("lang", "bit").collect():  # languages x bits
            right.setdefault(r.lang, (r.n, []))[1].append(r.good)
        model.weigh(right)
        shared.destroy()
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column (lang, score, ambiguous) made from the text alone."""
    shared = Shared(docs.sparkSession, model)

    @F.arrow_udf("struct<lang: string, score: double, ambiguous: boolean>")
    def predict(text: pa.Array) -> pa.Array:
        got = [shared.value.predict(t) for t in text.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                                           pa.array([g[2] for g in got], pa.bool_())], ["lang", "score", "ambiguous"])

    return docs.withColumn(into, predict(F.col(text_col).cast("string").cast("binary")))


def fold(id_col: str, folds: int):
    """The documents' fold: crc32 of the id's text modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
