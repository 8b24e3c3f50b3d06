"""Summarise the executed physical plan of every registered query (after AQE).

    python scripts/plan_report.py [sf_dir]            # table to stdout
    python scripts/plan_report.py [sf_dir] --write    # refresh PLANS.md, keep its notes

For each query: shuffles (hash / single-partition / range), broadcasts, join
strategies, windows, and the columns each parquet scan reads.  Each query's
DataFrame is collected, so the plan read back is AQE's final plan for it.
"""

from __future__ import annotations

import os
import re
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskengine.plans.queries import REGISTRY  # noqa: E402
from riskengine.session import local_session  # noqa: E402


def summarise(plan: str) -> dict:
    ops = Counter()
    for line in plan.splitlines():
        s = line.strip().lstrip(":+- *()0123456789")
        if s.startswith("Exchange hashpartitioning"):
            ops["hash shuffle"] += 1
        elif s.startswith("Exchange SinglePartition"):
            ops["single-partition exchange"] += 1
        elif s.startswith("Exchange rangepartitioning"):
            ops["range shuffle"] += 1
        elif s.startswith("BroadcastExchange"):
            ops["broadcast"] += 1
        elif s.startswith("ReusedExchange"):
            ops["reused exchange"] += 1
        if s.startswith("AQEShuffleRead") and "skewed" in s:
            ops["skew split"] += 1
        for op in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Window",
                   "TakeOrderedAndProject", "HashAggregate", "Generate"):
            if s.startswith(op):
                ops[op] += 1
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return {"ops": ops, "schemas": schemas}


NOTES_START = "## Steps that run before the returned plan"


def main(argv):
    write = "--write" in argv
    args = [a for a in argv[1:] if a != "--write"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    plans_md = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                            "PLANS.md")
    notes = ""
    if write and os.path.exists(plans_md):
        text = open(plans_md).read()
        notes = text[text.index(NOTES_START):] if NOTES_START in text else ""
    lines = []
    print_ = print
    if write:
        def print_(*a, **kw):  # noqa: ANN001 -- collect instead of printing
            lines.append(" ".join(str(x) for x in a) + kw.get("end", "\n"))
    spark = local_session(8)
    print_(f"# Executed plans at `{os.path.basename(sf_dir)}` (local[8], AQE final plans, "
           "read after collecting each query)\n")
    print_("Generated by `scripts/plan_report.py`. Counts are of physical operators in the "
          "final plan of the returned DataFrame (jobs run before it -- counts, quantiles, "
          "checkpoints, file writes -- are not included). HashAggregate counts partial and "
          "final steps separately. `sec` includes collecting the rows to the driver (this report "
          "only; the bench uses the `noop` sink).\n")
    print_("| query | sec | shuffles (hash / single / range) | broadcasts | joins | windows "
           "| scans read |")
    print_("| --- | --- | --- | --- | --- | --- | --- |")
    for name in REGISTRY:
        df = REGISTRY[name](spark, sf_dir)
        t0 = time.perf_counter()
        df.collect()
        secs = time.perf_counter() - t0
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        s = summarise(plan)
        o = s["ops"]
        joins = ", ".join(f"{o[j]} {j}" for j in ("SortMergeJoin", "BroadcastHashJoin",
                                                   "ShuffledHashJoin") if o[j]) or "-"
        if o["skew split"]:
            joins += f" ({o['skew split']} skew-split reads)"
        scans = "<br>".join(f"`{x}`" for x in s["schemas"]) or "-"
        print_(f"| `{name}` | {secs:.2f} | {o['hash shuffle']} / {o['single-partition exchange']}"
              f" / {o['range shuffle']} | {o['broadcast']} | {joins} | {o['Window']} "
              f"| {scans} |")
    spark.stop()
    if write:
        with open(plans_md, "w") as fh:
            fh.write("".join(lines) + ("\n" + notes if notes else ""))


if __name__ == "__main__":
    main(sys.argv)
