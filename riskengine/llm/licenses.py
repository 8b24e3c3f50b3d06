"""License scans: an exact set-similarity join of text blocks with license templates.

A block is ``2 * stride`` consecutive words of a text, and one starts every ``stride`` words, so
any span of ``stride`` words is whole in a block; ``stride`` is no less than the longest template.
A block matches a template when it contains at least ``threshold`` of the template's distinct
words.  The join:

* words are ordered by their frequency in the whole corpus, the rarest first (a native count of
  the templates' words over all documents);
* prefix filter: with ``m`` words of which ``need`` must be found, the ``m - need + 1`` rarest
  can't all be missing, so only blocks with one of those are candidates;
* length filter: a block of fewer than ``need`` distinct words isn't a candidate;
* positional filter: the word's places in both orders bound what can still overlap;
* what is left is verified by counting, so the join is exact.

Phrases are templates of threshold 1; in their blocks the places where the phrase's words stand
consecutively are listed, each by the block whose first half it starts in.  Templates are a
parameter of the call, some hundred words each, and travel with the tasks; documents don't
shuffle, and a document however long is handled block by block.

Defined cases: a null or empty text has no words and no match; a text shorter than a block is
one block; repeated rows get a row each; templates without words match nothing;
every template that matches is returned, so ties need no order; only the id and text columns are read,
so others may have any names.
"""

from __future__ import annotations

from collections import defaultdict
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, utf8, words
from .decontam import alnum_words

#: Base phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices that name a license without a base phrase, or at more length; label and text.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or at your "
            "option any later version"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
            "was not distributed with this file, You can obtain one"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software"),
    ("cc-by-nc", "CC BY-NC"),
    ("cc-by-sa", "CC BY-SA"),
]
THRESHOLD = 0.8
LEAST_STRIDE = 64

MATCH = "struct<label: string, phrase: boolean, block: int, score: double, places: array<int>>"


class Template:
    """A template's words, ordered by the corpus's frequencies once :meth:`order` is called."""

    def __init__(self, label: str, text: str, threshold: float, phrase: bool):
        self.label, self.phrase = label, phrase
        self.words = words(text.encode(), ALNUM)
        self.distinct = sorted(set(self.words))
        self.need = max(1, ceil(threshold * len(self.distinct) - 1e-9))

    def order(self, rank: dict[bytes, int]) -> None:
        self.ranks = sorted(rank[w] for w in self.distinct)
        self.sequence = [rank[w] for w in self.words]
        self.prefix = self.ranks[:len(self.ranks) - self.need + 1]


def templates(phrases=PHRASES, notices=NOTICES, threshold: float = THRESHOLD) -> list[Template]:
    out = [Template(label, text, 1.0, True) for text, label in phrases.items()]
    out += [Template(label, text, threshold, False) for label, text in notices]
    return [t for t in out if t.words]


def global_order(docs: DataFrame, of: list[Template], text_col: str = "text") -> dict[bytes, int]:
    """Ranks of the templates' words, rarest in the whole corpus first."""
    vocabulary = sorted({w.decode() for t in of for w in t.distinct})
    found = (docs.select(F.explode(alnum_words(text_col)).alias("w")).where(F.col("w").isin(vocabulary))
             .groupBy("w").count().collect())  # the templates' words at most
    count = {r["w"]: r["count"] for r in found}
    return {w.encode(): i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}


class Join:
    """Blocks of one text against the templates."""

    def __init__(self, of: list[Template], rank: dict[bytes, int]):
        self.rank, self.of = rank, of
        for t in of:
            t.order(rank)
        self.stride = max([LEAST_STRIDE, *(len(t.words) for t in of)])
        self.index = defaultdict(list)  # prefix word -> (template, its place in the template's order)
        for t in of:
            for j, r in enumerate(t.prefix):
                self.index[r].append((t, j))

    def match(self, ws: list[bytes]) -> list[tuple]:
        """(label, phrase, block, score, places) of every match in a text's words."""
        get = self.rank.get
        found = [(i, r) for i, r in enumerate([get(w, -1) for w in ws]) if r >= 0]
        if not any(r in self.index for _, r in found):
            return []
        blocks, out = defaultdict(list), []
        last = max(0, ceil(len(ws) / self.stride) - 2)  # the last block that isn't inside another
        for i, r in found:
            b = i // self.stride
            for x in {max(0, b - 1), b}:
                if x <= last:
                    blocks[x].append((i, r))
        for b in sorted(blocks):
            have = {r for _, r in blocks[b]}
            own, size, seen = sorted(have), None, set()
            for i, r in enumerate(own):
                for t, j in self.index.get(r, ()):
                    if id(t) in seen:
                        continue
                    # what can still overlap: this word, and the rest of either order
                    if 1 + min(len(own) - i - 1, len(t.ranks) - j - 1) + min(i, j) < t.need:
                        continue
                    if size is None:
                        size = len(set(ws[b * self.stride:(b + 2) * self.stride]))
                    if size < t.need:
                        continue
                    seen.add(id(t))
                    overlap = sum(x in have for x in t.ranks)
                    if overlap < t.need:
                        continue
                    places = self._places(blocks[b], t) if t.phrase else [blocks[b][0][0]]
                    if t.phrase:  # each place once: by the block whose first half it starts in, or the last
                        places = [p for p in places if p // self.stride == b or b == last]
                    if places:
                        out.append((t.label, t.phrase, b, overlap / len(t.ranks), places))
        return out

    @staticmethod
    def _places(hits: list[tuple[int, int]], t: Template) -> list[int]:
        """Starts of the template's whole sequence among (place, rank) hits."""
        at, ranks = [h[0] for h in hits], [h[1] for h in hits]
        n, out = len(t.sequence), []
        for k in range(len(hits) - n + 1):
            if at[k + n - 1] - at[k] == n - 1 and ranks[k:k + n] == t.sequence:
                out.append(at[k])
        return out


def scan(docs: DataFrame, of: list[Template], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, matches) for each row: every block and template that match."""
    join = Join(of, global_order(docs, of, text_col))

    def run(batches):
        for b in batches:
            n, got = [], []
            for t in b.column(1).to_pylist():
                ws = words(t, ALNUM)
                n.append(len(ws))
                got.append([dict(zip(("label", "phrase", "block", "score", "places"), m, strict=True)) for m in join.match(ws)])
            kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("block", pa.int32()),
                                       ("score", pa.float64()), ("places", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(got, kind)],
                                             ["doc_id", "n_words", "matches"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(docs, text_col)).mapInArrow(
        run, f"doc_id long, n_words long, matches array<{MATCH}>")


def summary(scanned: DataFrame) -> DataFrame:
    """One row a document: base places and labels, all labels, and the best containment."""
    base = F.filter("matches", lambda m: m.phrase)
    places = F.flatten(F.transform(base, lambda m: m.places))

    def joined(matches):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(matches, lambda m: m.label))))

    return scanned.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.score)), F.lit(0.0)).alias("score"))
