"""Token counts of whole texts, with a public tokenizer's own library.

Only lengths leave the tasks.  Spark cuts Arrow batches by bytes (``BATCH_BYTES``), so a batch of
long texts holds few of them.  In a task the texts of a batch are split at safe boundaries, places
where the tokenizer can't join what stands on both sides; equal pieces are encoded once, in library
calls of ``CALL_BYTES`` at most, and a text's count is the sum over its pieces.  A worker keeps the
counts of ``KEPT`` short pieces.

What is a safe boundary depends on the tokenizer, see :func:`boundary`; one whose rules are not
known here encodes whole texts.  The vocabulary file is read on the driver and broadcast, so that
workers need the library but not the file; files over ``MOST_BYTES`` are refused.

Defined cases: a null or empty text has 0 bytes and no tokens; bytes that are not UTF-8 count as
U+FFFD; a very long text costs as its length, one piece without a boundary is encoded whole;
repeated rows are counted each; an empty table gives none; other columns are not read and may
have any name.  Nothing depends on order, so there are no ties.
"""

from __future__ import annotations

import contextlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

BATCH_BYTES = 8 << 20    # of texts in an Arrow batch (one text at least)
CALL_BYTES = 1 << 20     # of pieces in a call of the library (one piece at least)
KEPT = 300_000           # pieces whose counts a worker keeps
KEPT_BYTES = 64          # longest of them
MOST_BYTES = 64 << 20    # of a vocabulary file

# The pattern of tokenizers that drop white space, and normalizers that act within a word.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                    {"type": "Lowercase"}]

#: Before a space that follows a visible ASCII character, a digit or a letter.
BEFORE_SPACE = re.compile(r"(?<=[!-~\w])(?= )")
#: A space between such characters, other spaces apart; the library puts a mark before each piece.
AT_SPACE = re.compile(r"(?<=[!-~\w]) (?= *[!-~\w])")


def boundary(kind: str, data: bytes) -> str:
    """``dropped``, ``leading``, ``marked`` or ``none``: where texts may be cut for this tokenizer.

    * dropped: at white space, which gives no token and separates words;
    * leading: before a space, which only joins what follows it;
    * marked: at a space between visible characters, where the library itself puts a mark before
      each text and no entry of the vocabulary has a mark after another character.
    """
    if kind == "sentencepiece":
        model = library(kind, data)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        marked = model.encode("a", out_type=str)[0].startswith("▁") and model.encode("a  b") == model.encode("a") + model.encode(" b")
        return "marked" if marked and not any(re.search("[^▁]▁", x) for x in names) else "none"
    spec = json.loads(data)
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
        return "none"
    steps = spec["pre_tokenizer"] or {}
    if steps == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        return "none" if spec["normalizer"] else "leading"
    first = (steps.get("pretokenizers") or [{}])[0]
    normal = spec["normalizer"] or {"normalizers": []}
    known = all(x in WORD_NORMALIZERS for x in normal.get("normalizers", [normal]))
    dropped = first.get("behavior") == "Removed" and first.get("invert") and first.get("pattern") == {"Regex": WORD_PATTERN}
    return "dropped" if known and dropped else "none"


def library(kind: str, data: bytes):
    """The tokenizer, made from the contents of its file."""
    if kind == "sentencepiece":
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=data)
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(data.decode())
    made.no_truncation()
    made.no_padding()
    return made


def lengths(kind: str, model, texts: list[str]) -> list[int]:
    """Tokens of each text, as the library gives them."""
    if kind == "sentencepiece":
        return [len(x) for x in model.encode(texts, num_threads=1)]
    return [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def pieces(texts: pa.Array, cut: str) -> pa.ListArray:
    """The pieces of each text (UTF-8 strings without nulls), whose counts add up to the text's."""
    if cut == "dropped":
        return pc.ascii_split_whitespace(texts)
    split = {"leading": BEFORE_SPACE.split, "marked": AT_SPACE.split, "none": lambda t: [t]}[cut]
    return pa.array([split(t) for t in texts.to_pylist()], pa.list_(pa.string()))


class Counter:
    """Counts tokens of batches of texts; keeps the counts of short pieces."""

    def __init__(self, kind: str, data: bytes, cut: str):
        self.kind, self.cut, self.model, self.seen = kind, cut, library(kind, data), {}

    def fill(self, wanted: list[str]) -> dict[str, int]:
        """Counts of pieces, encoded in calls of bounded size."""
        out, call, held = {}, [], 0
        for p in wanted:
            call.append(p)
            held += len(p)
            if held >= CALL_BYTES:
                out.update(zip(call, lengths(self.kind, self.model, call), strict=True))
                call, held = [], 0
        if call:
            out.update(zip(call, lengths(self.kind, self.model, call), strict=True))
        return out

    def count(self, texts: pa.Array) -> np.ndarray:
        lists = pieces(texts, self.cut)
        coded = lists.values.dictionary_encode()
        names = coded.dictionary.to_pylist()
        seen = self.seen
        new = self.fill([p for p in names if p not in seen])
        each = np.array([new[p] if p in new else seen[p] for p in names], np.int64)
        if len(seen) + len(new) > KEPT:
            seen.clear()
        seen.update({p: n for p, n in new.items() if len(p) <= KEPT_BYTES})
        sums = np.r_[0, np.cumsum(each[coded.indices.to_numpy()])] if len(names) else np.zeros(1, np.int64)
        ends = lists.offsets.to_numpy()
        return sums[ends[1:]] - sums[ends[:-1]]


def valid(texts: pa.Array) -> pa.Array:
    """Strings of bytes: null is empty, what is not UTF-8 becomes U+FFFD."""
    texts = pc.fill_null(texts, b"")
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


@contextlib.contextmanager
def batches_of(spark, n: int):
    """Arrow batches of ``n`` bytes for the actions inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def token_counts(docs: DataFrame, path: str, kind: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, by the vocabulary file at ``path`` on the driver.

    ``kind`` is ``tokenizers`` or ``sentencepiece``; by default the file's ending tells (.json, .model).
    """
    kind = kind or {"json": "tokenizers", "model": "sentencepiece"}[path.rsplit(".", 1)[-1]]
    with open(path, "rb") as f:
        data = f.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"a vocabulary of over {MOST_BYTES} bytes is not broadcast")
    spark = docs.sparkSession
    # a plain dict: workers keep it while the broadcast lives, and their counter in it
    shared = spark.sparkContext.broadcast({"data": data, "cut": boundary(kind, data)})

    def counted(batches):
        state = shared.value
        counter = state.get("counter")
        for b in batches:
            counter = counter or state.setdefault("counter", Counter(kind, state["data"], state["cut"]))
            at, out = 0, []
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy().astype(np.int64)
            # Spark bounds a batch of many rows; its first rows may still be long ones
            for end in np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH_BYTES, append=-1)) + 1:
                out.append(counter.count(valid(b.column(1).slice(at, end - at))))
                at = end
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(np.concatenate(out) if out else sizes)],
                                             ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind_of_id = rows.schema["id"].dataType.simpleString()
    with batches_of(spark, BATCH_BYTES):
        done = Scratch(spark, "tokens").save(rows.mapInArrow(counted, f"id {kind_of_id}, n_bytes long, n_tokens long"))
    return done.withColumnRenamed("id", id_col)
