"""The corpus pipeline: each stage against brute force on its own input, and the whole run."""

from __future__ import annotations

import importlib.util
import os
import subprocess
import sys

import corpus_pipeline
import pytest
from conftest import ROOT, SF_SMALL

from llm_fixtures import documents  # noqa: F401 -- a fixture
from riskengine.llm.common import table
from test_decontam import by_hand as leaks_by_hand
from test_simhash import by_hand as fingerprint_by_hand
from test_simhash import smallest_reachable
from test_substrings import by_hand as repeats_by_hand


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_one_by_one(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "substring_dedup", "decontamination", "mixing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != "mixing":
            assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs)

    before, after = map(pairs, seen["language_id"])
    gone = set(before) - set(after)
    assert set(after) <= set(before) and len(gone) <= 0.02 * len(before)

    before, after = map(pairs, seen["simhash_near_dedup"])
    least = smallest_reachable([fingerprint_by_hand(t) for _, t in before], [i for i, _ in before])
    assert sorted(after) == sorted((i, t) for (i, t), c in zip(before, least) if i == c)

    before, after = map(pairs, seen["substring_dedup"])
    want = [(i, kept if gone else t) for (i, t), (_, _, gone, _, kept) in zip(before, repeats_by_hand(before))]
    assert sorted(after) == sorted(want)
    assert all(r.n_chars == len(r.text) for r in seen["substring_dedup"][1].collect())

    before, after = map(pairs, seen["decontamination"])
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    want = [d for d, h in zip(before, leaks_by_hand(before, items)) if not h[5]]
    assert sorted(after) == sorted(want) and len(want) < len(before)

    before, after = seen["mixing"]
    rows = after.collect()
    size = {i: len(t.encode().split()) for i, t in pairs(before)}
    assert {r.doc_id: r["size"] for r in rows} == size and all(r.taken <= 3 * r["size"] for r in rows)


def test_run_is_the_stages_in_turn_and_repeats(spark):
    a = sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect()))
    assert a == sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) and a
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, None), (2, "")],
                                  [(1, "the words of one text " * 20), (1, "the words of one text " * 20), (None, "und die das " * 9, "de", None)]])
def test_stages_take_any_rows(spark, documents, rows):
    docs = documents(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert name == "mixing" or out.columns == docs.columns
        out.collect()
        docs = spark.createDataFrame(out.collect(), out.schema) if name != "mixing" else docs


def test_the_rest_works_without_this_package(tmp_path):
    """__spark_entry__ and the other queries import when the package and the pipeline are gone."""
    for name in ("riskengine", "__spark_entry__.py"):
        os.symlink(f"{ROOT}/{name}", f"{tmp_path}/{name}") if name.endswith(".py") else None
    os.makedirs(f"{tmp_path}/riskengine")
    for part in os.listdir(f"{ROOT}/riskengine"):
        if part not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/riskengine/{part}", f"{tmp_path}/riskengine/{part}")
    code = (f"import sys, importlib.util as u; sys.path.insert(0, {str(tmp_path)!r}); sys.path = [p for p in sys.path if p != {ROOT!r}]\n"
            f"s = u.spec_from_file_location('__spark_entry__', {str(tmp_path)!r} + '/__spark_entry__.py')\n"
            "m = u.module_from_spec(s); s.loader.exec_module(m); q = m.queries()\n"
            "assert 'feature_engineering' in q and not any(x.startswith('op') or x == 'pipeline' for x in q), list(q)\n"
            "assert set(m.oracle_sql()) <= set(q); print('fine')")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=120)
    assert got.stdout.strip() == "fine", got.stderr[-800:]


def test_all_queries_are_registered():
    spec = importlib.util.spec_from_file_location("entry_under_test", f"{ROOT}/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = list(entry.queries())
    assert [n for n in range(1, 11) if sum(x.startswith(f"op{n}_") for x in names) == 1] == list(range(1, 11))
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
