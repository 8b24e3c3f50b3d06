"""Spelling variants: words one edit apart, by a variable-length gram index.

**Words** are runs of letters, counted over whole texts: tasks count and send what they hold when
it is full, and a native grouped sum merges the counts.

**Gram dictionary.**  All grams of ``SHORTEST`` code points are in it, and longer ones that occur
more often than a threshold, up to ``LONGEST``: frequent grams are told apart by what follows,
rare ones stay short.  The threshold is the occurrences over ``GRAMS``, so fewer than ``GRAMS``
grams of a length pass it, and the dictionary is broadcast with that bound.

**Variable grams of a word.**  At each place the longest gram of the dictionary that starts there;
one that ends no later than an earlier one is dropped.

**Affected grams.**  How far an edit can change that choice is bounded per gram
(:func:`lasting`): edits at or behind ``after`` leave the gram and all in front of it as they are,
edits before ``before`` leave it and all behind it.  The places of an edit fall into three windows,
the word's start, middle and end.  An edit in a window leaves the grams whose bounds lie outside it,
and these are the same grams in both words: so the lists of the last one in front of the window and
of the first one behind it are merged, which means that two words are compared if they agree on
both grams, with all that stands on their far sides (:func:`merged_lists`).  Every word stands in
three lists for its own length and three for words that are one shorter.  Grams are at most half of
a word long, which is when such grams always exist.  What the lists propose is verified by edit
distance, inside the join, so that a list's pairs are never rows.

A word's **form** is its most frequent near word, if that is ``factor`` times as frequent; forms
are followed to the last, the **root**.  A step multiplies the count, so chains are short.

Defined cases: a null or empty text has no words; very long texts and runs cost as their length;
ties between forms go to the smaller word; repeated rows count each; an empty table gives none;
other columns are not read and may have any name.  Bytes that are not UTF-8 end a run.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, utf8

SHORTEST, LONGEST = 2, 3   # code points of a gram; longer ones would leave less on the sure side
GRAMS = 20_000             # grams of one length above the threshold: fewer than these
TASK_WORDS = 200_000       # distinct words that a task holds before it sends them on
STEPS = 5                  # doublings that follow forms; 2 ** 5 steps of a factor of 2 exceed a long


# --- words ------------------------------------------------------------------------------

def word_counts(docs: DataFrame, change=None, shortest: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the maximal runs of letters, A-Z in lower case, of at least ``shortest`` code points.

    ``change(start, run)`` may replace a run; ``start`` is made from the document's id by
    ``change.start``, once for each document.  A replaced run counts if it is still long enough.
    """
    run = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, shortest))

    def count(batches):
        total: dict[str, int] = {}
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not t:
                    continue
                found = Counter(run.findall(t.translate(LOWER).decode("utf-8", "replace")))
                if change is None:
                    for w, n in found.items():
                        total[w] = total.get(w, 0) + n
                else:
                    start = change.start(i)
                    for w, n in found.items():
                        w = change(start, w)
                        if len(w) >= shortest:
                            total[w] = total.get(w, 0) + n
                if len(total) > TASK_WORDS:
                    yield _counted(total)
                    total.clear()
        yield _counted(total)

    rows = docs.select(F.col(id_col).cast("string").alias("id"), utf8(docs, text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(total: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


# --- grams ------------------------------------------------------------------------------

def longest_gram(n: int) -> int:
    """Code points of the grams for words of ``n`` and those one longer."""
    return max(1, min(LONGEST, n // 2))


def reach(word: str, at: int, known: frozenset, most: int) -> tuple[int, int]:
    """End of the longest gram at a place, and the last place that was looked at to find it."""
    end = at + min(SHORTEST, most)
    while end - at < most:
        if word[at:end + 1] not in known or end >= len(word):
            return end, end
        end += 1
    return end, end - 1


def lasting(word: str, known: frozenset, most: int) -> list[tuple[int, int, int, int]]:
    """(start, end, after, before) of the word's variable grams.

    Places are code points from 0; an edit at ``i`` replaces or deletes code point ``i``, or inserts
    before it.  The gram is also one of the other word's, and all that stands before its end is
    equal, if ``i >= after``.  All that stands from its start on is equal, if ``i < before`` (or an
    insertion's ``i == before``).
    """
    found = [(p, *reach(word, p, known, most)) for p in range(len(word) - min(SHORTEST, most) + 1)]
    out, furthest = [], 0
    for k, (p, end, _) in enumerate(found):
        if end <= furthest:
            continue
        furthest = end
        # an earlier gram that an edit lengthens can swallow this one, if it can get as far as its end
        seen = max(last for q, _, last in found[max(0, k - most):k + 1] if q == p or q + most >= end)
        out.append((p, end, seen + 1, min(p, end - most)))
    return out


def merged_lists(word: str, known: frozenset, n: int) -> list[tuple[str, str]]:
    """(start, end) for each window of edits: what stays of a word through its last gram in front of
    the window and from its first gram behind it.

    ``n`` is the length of the shorter word of a pair, ``word`` has it or is one longer.  Two words
    one edit apart have one of these in common, at the same position of the list.
    """
    most = longest_gram(n)
    grams, outer = lasting(word, known, most), max(n // 3, most)
    middle = n - 2 * outer

    def start(place: int) -> str:  # counted from the start of the word
        return word[:max(e for _, e, after, _ in grams if after <= place)]

    def end(place: int) -> str:    # counted from its end
        return word[min(p for p, _, _, before in grams if before >= len(word) - place):]

    windows = [("", end(n - outer)), (start(n - outer), "")]
    return windows + [(start(outer), end(outer))] if middle else windows


def _postings(known, lengths: tuple[int, ...]):
    """The keys of words as the shorter of a pair (its length less 0) and as the longer one (less 1)."""

    def run(batches):
        held = known.value
        for b in batches:
            out = [(w, start, end, window, len(w) - less, less) for w in b.column(0).to_pylist() for less in lengths
                   for window, (start, end) in enumerate(merged_lists(w, held, len(w) - less))]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, kinds, strict=True)],
                                             ["word", "start", "end", "window", "n", "less"])

    return run


def gram_dictionary(words: DataFrame) -> frozenset:
    """Grams longer than ``SHORTEST`` that occur more often than the threshold."""
    wanted = range(SHORTEST + 1, LONGEST + 1)
    length = F.length("word")
    total = words.agg(F.sum(length)).first()[0] or 0
    # a word of n code points has fewer than n grams of a length
    threshold = math.ceil(total / GRAMS)
    grams = F.flatten(F.array(*[F.when(length >= k, F.transform(F.sequence(F.lit(1), length - k + 1), lambda i, k=k: F.substr(F.col("word"), i, F.lit(k))))
                                .otherwise(F.array().cast("array<string>")) for k in wanted]))
    found = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().where(F.col("count") > max(1, threshold))
    return frozenset(r.gram for r in found.select("gram").collect())


# --- links, forms -----------------------------------------------------------------------

def near_words(scratch: Scratch, words: DataFrame) -> DataFrame:
    """(a, b) of all distinct words that differ by one inserted, deleted or replaced code point.

    Words have at least 4 code points; each pair is there once.
    """
    known = words.sparkSession.sparkContext.broadcast(gram_dictionary(words))
    kinds = "word string, start string, end string, window int, n int, less int"
    posted = lambda name, *less: words.select("word").mapInArrow(_postings(known, less), kinds).select(
        F.col("word").alias(name), F.col("less").alias(f"{name}_less"), F.xxhash64("start", "end", "window", "n").alias(f"{name}_key"))
    pair = (F.col("b_less") == 1) | (F.col("a") < F.col("b"))
    found = posted("a", 0).join(posted("b", 0, 1), (F.col("a_key") == F.col("b_key")) & pair & (F.levenshtein("a", "b", 1) == 1))
    return scratch.save(found.select("a", "b").distinct())


def forms(words: DataFrame, links: DataFrame, factor: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest count, if ``factor`` times as frequent."""
    both = links.union(links.select("b", "a")).toDF("word", "near")
    counted = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # the smallest of (-count, word) is the most frequent, then the smallest word
    best = both.join(counted, "near").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    enough = -F.col("best.m") >= factor * F.col("n").cast("decimal(38,0)")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"))


def roots(scratch: Scratch, table: DataFrame) -> DataFrame:
    """``table`` (word, form, ...) with the last of each word's chain of forms as ``root``."""
    step = scratch.save(table.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    for _ in range(STEPS):
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not step.join(ahead, "root", "left_semi").take(1):
            break
        step = scratch.save(step.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return table.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, change=None, shortest: int = 7, least: int = 2, factor: int = 10,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``docs`` that occur ``least`` times.

    ``shortest`` is 4 at least (see :func:`longest_gram`), ``factor`` 2 at least, so that forms end.
    """
    if shortest < 4 or factor < 2:
        raise ValueError("words of 4 code points or more and a factor of 2 or more are needed")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.save(word_counts(docs, change, shortest, id_col, text_col).where(F.col("n") >= least))
    found = scratch.save(forms(words, near_words(scratch, words), factor))
    return roots(scratch, found).select("word", "form", "root", "n", "n_near", "form_n")
