"""Every query in a session whose workers cannot import the package."""

from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL

SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # the driver's path alone: workers start without it
import corpus_pipeline
from riskengine.llm.queries import QUERIES
from riskengine.session import local_session
spark = local_session(4, shuffle_partitions=4)


def importable(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("riskengine") is not None])], ["x"])


importable.__module__ = "__main__"
assert not any(r.x for r in spark.range(4).mapInArrow(importable, "x boolean").collect())
for name, query in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    print(name, query(spark, {sf!r}).count(), flush=True)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    path = tmp_path / "run.py"
    path.write_text(SCRIPT.format(root=ROOT, sf=SF_SMALL))
    done = subprocess.run([sys.executable, str(path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith(("op", "pipeline")))
    assert len(counts) == 14 and all(int(n) >= 0 for n in counts.values())
