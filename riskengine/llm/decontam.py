"""Benchmark decontamination by winnowing, in DataFrame operations.

A window is ``length`` consecutive words of a benchmark item (a shorter item is one window).
Each window's fingerprint is the least hash of its k-grams.  A document keeps the least hash of
every sliding run of as many k-grams, so a span that it shares with an item, being as long as a
window, always has a fingerprint in common.

1. One pass over the documents counts words and keeps their distinct fingerprints.
2. Fingerprints meet the benchmark's in an equi-join; this names the documents to look at.
3. In those, each window with a known fingerprint is compared with the benchmark's windows
   word by word (an equi-join on its text), and the matches are extended to the words they
   cover.  Nothing is paired within a group: a passage in very many documents is one window
   of the benchmark, joined by each.

Items shorter than a window have windows, and fingerprints, of their own length (one more run
of fingerprints for each such length below ``length``).  The benchmark is broadcast only where
Spark's measured size of it is under the session's threshold; otherwise the joins shuffle.

Defined cases: null and empty texts have no words; an item without words has no window; equal
items count by their distinct ids, and an item with a null id marks words but isn't listed; rows
of equal id and text get equal results; a null doc_id is kept; a very long text is marked whole;
all items whose windows occur are counted, so ties need no order; only the id and text columns
are read, so others may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_ALNUM, Scratch, lower_ascii, union_all

GRAM = 5


def alnum_words(text: str) -> Column:
    """Lower-cased words of a text as an array."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text).cast("string"), F.lit(""))), NOT_ALNUM), "")


def with_least_grams(df: DataFrame, words: str, length: int, into: str) -> DataFrame:
    """``df`` with, for each window of ``length`` words, the least hash of its k-grams (none if too short).

    Hashes roll by doubling: of 1, 2, 4, ... words joined up to k, then minima of 1, 2, 4, ...
    neighbours up to the window.  Each step is a column of its own, so that it is computed once.
    """
    columns, k = df.columns, min(GRAM, length)

    def shifted(x, by):
        return F.slice(x, by + 1, F.greatest(F.size(x) - by, F.lit(0)))

    def step(name, x, y, by, join):
        nonlocal df
        df = df.withColumn(name, F.zip_with(F.col(x), shifted(F.col(y), by), join))
        return name

    df = df.withColumn("_h1", F.transform(words, lambda x: F.xxhash64(x)))
    part, have, gram, done = "_h1", 1, None, 0
    while True:
        if k & have:
            gram = part if gram is None else step(f"_g{have}", gram, part, done, lambda a, b: F.xxhash64(a, b))
            done += have
        if have * 2 > k:
            break
        part, have = step(f"_h{2 * have}", part, part, have, lambda a, b: F.xxhash64(a, b)), have * 2
    width, have = length - k + 1, 1
    while have * 2 <= width:
        gram, have = step(f"_m{2 * have}", gram, gram, have, lambda a, b: F.least(a, b)), have * 2
    if width > have:
        gram = step("_m", gram, gram, width - have, lambda a, b: F.least(a, b))
    # entries past the last whole window are cut off
    whole = F.slice(gram, 1, F.greatest(F.size(words) - length + 1, F.lit(0)))
    return df.select(*columns, whole.alias(into))


def benchmark_windows(items: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """(size, window, item): every window of every item; ``size`` is its number of words."""
    w = items.select(F.col(id_col).cast("string").alias("item"), alnum_words(text_col).alias("w"))
    w = w.withColumn("size", F.least(F.size("w"), F.lit(length))).where("size > 0")
    return w.select("size", "item", F.explode(F.expr(
        "transform(sequence(0, size(w) - size), i -> concat_ws(' ', slice(w, i + 1, size)))")).alias("window"))


def hits(scratch: Scratch, docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows as (doc_id, row, n_words), and those with hits as (_id, _row, n_hit, items).

    ``row`` is a hash of the text, which tells rows of one id apart.
    """
    of_item = scratch.save(benchmark_windows(items, length, item_col, item_text).distinct())
    sizes = sorted(r[0] for r in of_item.select("size").distinct().collect())  # at most ``length`` numbers
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("row"),
                         alnum_words(text_col).alias("w"))
    sizes = sizes or [length]
    prints = source
    for m in sizes:
        prints = with_least_grams(prints, "w", m, f"f{m}")
    scan = scratch.save(prints.select("doc_id", "row", F.size("w").cast("long").alias("n_words"),
                                      *[F.array_distinct(f"f{m}").alias(f"f{m}") for m in sizes]))
    known = of_item.select("size", "window").distinct().withColumn("w", F.split("window", " "))
    known = scratch.save(union_all([
        with_least_grams(known.where(F.col("size") == m), "w", m, "f").select("size", "window", F.col("f")[0].alias("f"))
        for m in sizes]))
    suspects = union_all([
        scan.select("doc_id", "row", F.explode(f"f{m}").alias("f"))
        .join(known.where(F.col("size") == m).select("f").distinct(), "f", "left_semi").select("doc_id", "row")
        for m in sizes]).distinct()
    suspects = scratch.save(suspects.toDF("_id", "_row"))
    looked_at = source.join(suspects, same_row(), "left_semi")
    places = []
    for m in sizes:
        at = F.expr(f"transform(f, (x, i) -> struct(x AS f, i AS at, concat_ws(' ', slice(w, i + 1, {m})) AS window))")
        places.append(with_least_grams(looked_at, "w", m, "f").select("doc_id", "row", F.explode(at).alias("p"))
                      .select("doc_id", "row", "p.f", "p.at", "p.window")
                      .join(known.where(F.col("size") == m).select("f", "window"), ["f", "window"])
                      .select("doc_id", "row", "at", "window", F.lit(m).alias("size")))
    places = scratch.save(union_all(places))
    covered = places.groupBy("doc_id", "row").agg(F.collect_set(F.struct("at", "size")).alias("s")).select(
        "doc_id", "row", F.size(F.array_distinct(F.flatten(F.expr(
            "transform(s, x -> sequence(x.at, x.at + x.size - 1))")))).cast("long").alias("n_hit"))
    found = (places.select("doc_id", "row", "window", "size").distinct().join(of_item, ["window", "size"])
             .select("doc_id", "row", "item").where("item is not null").distinct().groupBy("doc_id", "row")
             .agg(F.sort_array(F.collect_list("item")).alias("items")).withColumnsRenamed({"doc_id": "_id", "row": "_row"}))
    got = covered.join(found, same_row(), "left").select(
        F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return scan.select("doc_id", "row", "n_words"), scratch.save(got)


def same_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, **columns: str) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``."""
    scan, hit = hits(Scratch(docs.sparkSession, "decontam"), docs, items, length, **columns)
    return scan.join(hit, same_row(), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id",
                         text_col: str = "text", **columns: str) -> DataFrame:
    """``docs`` less the documents that hold a benchmark window."""
    _, hit = hits(Scratch(docs.sparkSession, "decontam"), docs, items, length, id_col, text_col, **columns)
    same = hit["_id"].eqNullSafe(docs[id_col]) & (hit["_row"] == F.xxhash64(docs[text_col].cast("string")))
    return docs.join(hit, same, "left_anti")
