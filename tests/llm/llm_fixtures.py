from __future__ import annotations

import pytest

#: Documents with an extra column for every name that the operators use inside.
CLASHING = ("doc", "row", "fp", "group", "_id", "_row", "spans", "d", "o", "y", "w", "language", "bucket", "size", "key",
            "target", "score", "part", "n_words", "id")


@pytest.fixture
def documents(spark):
    """Builds documents from (doc_id, text) or (doc_id, text, lang, source) rows, with clashing columns."""

    def build(rows):
        full = [(*r, *("en", "src0")[len(r) - 2:])[:4] for r in rows]
        full = [(i, t, lang, src, None if t is None else len(t), *range(len(CLASHING))) for i, t, lang, src in full]
        extra = ", ".join(f"`{c}` int" for c in CLASHING)
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")

    return build
