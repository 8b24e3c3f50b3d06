"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations.

A document of a source with target ``t`` and size ``s`` is worth ``t / s`` copies.  The whole
part is certain; the fraction is a probability of one more copy.  Pivotal rounding settles the
fractions: two documents trade words of expected mass until one's probability is 0 or 1, which
way being random in proportion, so that each probability and their sum in words are kept.  One
undecided document is left over from a chunk of documents; the leftovers of chunks are chunked
again, a reduction tree whose depth is the logarithm of the source's size.  A chunk has about
``CHUNK`` documents whatever the source holds, so a hot source is many small folds.  In the end
one document a source is rounded alone: the taken words miss the target by less than its size.
So that this one is small, a source's documents are rounded from the few large ones down (those
over an eighth of it, over a 64th, ..., the rest), each class sharing what the larger ones left
of the target; in a chunk, too, large ones trade first.

Randomness is hashed from ids, copy numbers, the level and the seed, so reruns agree.  Rows of equal
id, size and source are numbered, over range partitions and not in one task, so that they have hashes
of their own and spread over chunks like others.

Defined cases: a null text has size 0 and a document of size 0 is taken 0 words; a null source
is a source, ordered last; ids may repeat or be null (equal rows are interchangeable, and which of
them are taken more often is told by their numbers); documents of equal size are ordered by hash;
texts of any length are only counted, and a document longer than a chunk's others trades first;
columns beside id, source and text, whatever their names, are not read; an empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ASCII_SPACE, Scratch, union_all

CHUNK = 256
LARGE = (8, 64, 512, 4096)
MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
SEED = 20

UNIT = "key long, doc_id long, size long, whole long, prob double"
NUMBERED = f"{UNIT}, copy long"
FIELDS = ("key", "doc_id", "size", "whole", "prob", "copy")

#: Trades between the carried document ``s.c`` and the next one ``x``.  ``d.up`` is the mass that
#: can move to the carried one and ``d.down`` from it; afterwards one of both is settled.
FOLD = """
aggregate(items,
  named_struct('c', cast(null AS struct<{unit}>), 'done', cast(array() AS array<struct<{unit}>>)),
  (s, x) -> CASE WHEN s.c IS NULL THEN named_struct('c', x.unit, 'done', s.done) ELSE
    transform(
      transform(array(named_struct('up', least((1 - s.c.prob) * s.c.size, x.unit.prob * x.unit.size),
                                   'down', least(s.c.prob * s.c.size, (1 - x.unit.prob) * x.unit.size))),
        d -> CASE
          WHEN x.u * (d.up + d.down) < d.down AND (1 - s.c.prob) * s.c.size <= x.unit.prob * x.unit.size THEN
            named_struct('first', 1D, 'next', x.unit.prob - d.up / x.unit.size, 'carry', false)
          WHEN x.u * (d.up + d.down) < d.down THEN
            named_struct('first', s.c.prob + d.up / s.c.size, 'next', 0D, 'carry', true)
          WHEN s.c.prob * s.c.size <= (1 - x.unit.prob) * x.unit.size THEN
            named_struct('first', 0D, 'next', x.unit.prob + d.down / x.unit.size, 'carry', false)
          ELSE named_struct('first', s.c.prob - d.down / s.c.size, 'next', 1D, 'carry', true) END),
      t -> transform(array(named_struct(
          'a', named_struct('key', s.c.key, 'doc_id', s.c.doc_id, 'size', s.c.size, 'whole', s.c.whole,
                            'prob', greatest(0D, least(1D, t.first)), 'copy', s.c.copy),
          'b', named_struct('key', x.unit.key, 'doc_id', x.unit.doc_id, 'size', x.unit.size,
                            'whole', x.unit.whole, 'prob', greatest(0D, least(1D, t.next)), 'copy', x.unit.copy))),
        v -> CASE WHEN t.carry THEN named_struct('c', v.a, 'done', concat(s.done, array(v.b)))
                  ELSE named_struct('c', v.b, 'done', concat(s.done, array(v.a))) END)[0])[0] END)
""".format(unit=", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in NUMBERED.split(", ")).replace("long", "bigint"))


def n_words(text: str | Column) -> Column:
    """Number of words (runs of anything but ASCII white space); 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.array_remove(F.split(text.cast("string"), ASCII_SPACE), "")
    return F.when(text.isNull(), 0).otherwise(F.size(found)).cast("long")


def _uniform(*cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(float(1 << 53))


def numbered(scratch: Scratch, df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with its global row number from 1 as ``n``: range partitions, then their offsets."""
    parts = df.sparkSession.sparkContext.defaultParallelism
    cut = scratch.save(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    start = (cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
             .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return cut.withColumn("n", own).join(start, "_part").withColumn("n", F.col("n") + F.col("_start")).drop("_part", "_start")


def with_copies(scratch: Scratch, sizes: DataFrame) -> DataFrame:
    """``sizes`` (doc_id, source, size, part) with ``copy``: rows equal in the first three are numbered from 0.

    A row's number is its own within its written part plus the equal rows of earlier parts, so a third
    of all rows may be equal and no task has more of them than a part, or one row a part.
    """
    same = ["doc_id", "source", "size"]
    repeated = scratch.save(sizes.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    if repeated.isEmpty():
        return sizes.withColumn("copy", F.lit(0).cast("long")).drop("part")

    def matched(left: DataFrame, right: DataFrame, how: str, keys=same) -> DataFrame:
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        return left.alias("l").join(right.alias("r"), on, how)

    equal = matched(sizes, repeated, "left_semi")
    earlier = Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = (equal.groupBy(*same, "part").agg(F.count(F.lit(1)).alias("rows"))
             .select(*same, "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start")))
    own = equal.withColumn("own", F.row_number().over(Window.partitionBy(*same, "part").orderBy("part")) - 1)
    told = matched(own, start, "inner", [*same, "part"]).select(*[f"l.{k}" for k in same], (F.col("own") + F.col("start")).alias("copy"))
    single = matched(sizes, repeated, "left_anti").withColumn("copy", F.lit(0).cast("long")).drop("part")
    return scratch.save(single.unionByName(told))


def source_targets(scratch: Scratch, sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, key, source_size, n_docs, target): weighted shares of all words, none above its cap.

    Shares stop at ``max_copies`` times the source's size and the excess goes to the others by
    weight: target = min(cap, level * weight), and the level rises until the sum is all words.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = scratch.save(numbered(scratch, per, order).withColumn("weight", weight))
    cap = F.col("source_size") * max_copies
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while total:
        over = cap <= F.lit(level) * F.col("weight")
        fixed, free, n = per.agg(F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))),
                                 F.count_if(over)).first()
        if n == capped or not free:
            break
        level, capped = (total - fixed) / free, n
    return per.select("source", F.col("n").cast("long").alias("key"), "source_size", "n_docs",
                      F.least(cap.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def settle(scratch: Scratch, units: DataFrame, seed: int = SEED) -> DataFrame:
    """``units`` (key, doc_id, size, whole, prob) with every ``prob`` rounded to 0 or 1.

    A column ``copy`` tells units of equal key, id and size apart; without it they share chunks.
    """
    units = (units if "copy" in units.columns else units.withColumn("copy", F.lit(0))).select(
        *[F.col(c) for c in FIELDS[:-1]], F.col("copy").cast("long").alias("copy"))
    fraction = (F.col("prob") > 0) & (F.col("prob") < 1) & (F.col("size") > 0)
    settled = [units.where(~fraction)]
    left, level = units.where(fraction), 0
    while True:
        left = scratch.save(left)
        count = left.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        most = count.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            alone = (_uniform("doc_id", "copy", F.lit(seed), F.lit(-1)) < F.col("prob")).cast("double")
            return union_all([*settled, left.withColumn("prob", alone)])
        chunk = F.pmod(F.xxhash64("doc_id", "size", "copy", F.lit(seed), F.lit(level)), F.ceil(F.col("n") / CHUNK))
        # large documents trade first, so what is left over at the end is small
        item = F.struct((-F.col("size")).alias("large_first"),
                        F.xxhash64("doc_id", "size", "copy", F.lit(seed), F.lit(level), F.lit("order")).alias("o"),
                        _uniform("doc_id", "copy", F.lit(seed), F.lit(level)).alias("u"),
                        F.struct(*FIELDS).alias("unit"))
        folded = (left.join(count, "key").groupBy("key", chunk.alias("chunk"))
                  .agg(F.sort_array(F.collect_list(item)).alias("items"))
                  .select(F.expr(FOLD).alias("f")).select("f.c", "f.done"))
        folded = scratch.save(folded)
        settled.append(folded.select(F.explode("done").alias("d")).select("d.*"))
        left, level = folded.select("c.*"), level + 1


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.save(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                     F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"),
                                     F.spark_partition_id().alias("part")))
    sizes = with_copies(scratch, sizes)
    targets = scratch.save(source_targets(scratch, sizes, weights, max_copies))
    rows = sizes.join(targets, sizes.source.eqNullSafe(targets.source)).select(
        "key", "doc_id", "size", "copy", "source_size", "target")
    done = None
    for i, share in enumerate((*LARGE, None)):
        part = rows if i == 0 else rows.where(F.col("size") * LARGE[i - 1] <= F.col("source_size"))
        part = part if share is None else part.where(F.col("size") * share > F.col("source_size"))
        seen, got = F.lit(0), F.lit(0)
        if done is not None:  # what larger documents took of the target, and their size
            taken = done.groupBy("key").agg(F.sum("size").alias("seen"), F.sum(F.col("copies") * F.col("size")).alias("got"))
            part = part.join(taken, "key", "left")
            seen, got = F.coalesce("seen", F.lit(0)), F.coalesce("got", F.lit(0))
        worth = (F.col("target") - got) / F.nullif(F.col("source_size") - seen, F.lit(0))
        part = scratch.save(_round(scratch, part, worth, max_copies, seed + i))
        done = part if done is None else done.unionByName(part)
    return done.join(targets.select("key", "source_size", "target"), "key").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def _round(scratch: Scratch, rows: DataFrame, worth: Column, max_copies: int, seed: int) -> DataFrame:
    """(key, doc_id, size, copies): ``worth`` copies of each row, rounded."""
    worth = F.greatest(F.lit(0.0), F.least(F.lit(float(max_copies)), F.coalesce(worth, F.lit(0.0))))
    units = rows.select("key", "doc_id", "size", "copy", F.floor(worth).alias("whole"), (worth - F.floor(worth)).alias("prob"))
    return settle(scratch, units, seed).select(
        "key", "doc_id", "size", (F.col("whole") + F.col("prob").cast("long")).alias("copies"))
