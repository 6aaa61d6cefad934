"""Summarise the physical plans of the headline queries (exchanges, scans, codegen).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusprep.plans.queries import QUERIES  # noqa: E402
from corpusprep.session import get_spark  # noqa: E402

HEADLINE = ["length_profile", "filter_funnel", "word_freq", "bucket_batches", "reason_counts", "word_split",
            "pack_batches", "token_accuracy"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 8)
    print(f"# Physical plans of the headline queries\n\nGenerated by `tools/plan_report.py` on `{sf_dir}`"
          " (local[8], AQE on; the initial plan, before runtime re-optimisation).\n")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = re.findall(r"Exchange (\w+)(?:\(([^)]*)\))?", plan)
        # a cached relation prints its inner plan at every use; report each distinct exchange once
        exchanges = list(dict.fromkeys(exchanges))
        scans = re.findall(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\].*?ReadSchema: (struct<[^>]*>)", plan)
        cached = plan.count("InMemoryTableScan")
        windows = plan.count("Window [")
        gens = plan.count("Generate ")
        codegen = plan.count("*(")
        print(f"## {name}\n")
        for kind, arg in exchanges:
            print(f"- Exchange `{kind}` {('on `' + arg.split(',')[0] + '`') if arg else ''}")
        for fmt, cols, pushed, schema in dict.fromkeys(scans):
            print(f"- Scan {fmt}: columns `{cols}`; pushed filters `[{pushed}]`; `ReadSchema: {schema}`")
        if cached:
            print(f"- reads {cached} cached relation(s)")
        if windows:
            print(f"- {windows} window operator(s)")
        if gens:
            print(f"- {gens} generator(s) (explode)")
        print(f"- whole-stage-codegen stages: {codegen}\n")


if __name__ == "__main__":
    main()
