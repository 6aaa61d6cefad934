"""Benchmark the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MERGES (default 0: bpe_learn learns to its end, 30,000 tokens), BENCH_REPEAT (default 3; the best run
after the first, warm-up, run is reported; with 1 the single run is reported).

Each query is executed completely with a ``noop`` write (no collection to the driver). All cached data is
dropped before every run, so the warm figures hold the whole work of a query; only code is warm. bpe_learn runs once (cold);
encode uses its model. Rows are
dealt out to all cores after the scan, as the tables are single row groups.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
MERGES = int(os.environ.get("BENCH_MERGES", "0")) or None
REPEAT = max(1, int(os.environ.get("BENCH_REPEAT", "3")))


def main() -> None:
    from pyspark.sql import functions as F

    from corpusprep.config import VocabConfig
    from corpusprep.operators.vocab import encode, learn_bpe
    from corpusprep.plans.queries import QUERIES
    from corpusprep.session import get_spark
    from corpusprep.sources.tables import SCAN_PARTITIONS, table

    spark = get_spark(f"local[{CPUS}]", CPUS)
    spark.conf.set(SCAN_PARTITIONS, str(CPUS))

    def run_df(name):
        def go():
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return go

    learnt = {}

    def run_bpe():
        texts = table(spark, SF_DIR, "documents", ["doc_id", "text"]).select("text")
        learnt["model"] = learn_bpe(texts, VocabConfig(), max_merges=MERGES)

    def run_encode():
        docs = encode(table(spark, SF_DIR, "documents", ["text"]), learnt["model"], "text")
        docs.write.format("noop").mode("overwrite").save()

    plan = {
        "length_profile": run_df("length_profile"),
        "filter_funnel": run_df("filter_funnel"),
        "word_freq": run_df("word_freq"),
        "bucket_batches": run_df("bucket_batches"),
        "bpe_learn": run_bpe,
        "encode": run_encode,
    }
    docs = table(spark, SF_DIR, "documents", ["doc_id", "text"])
    n_docs = docs.count()
    n_chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0

    times, cold = {}, {}
    for name, fn in plan.items():
        runs = []
        for _ in range(1 if name == "bpe_learn" else REPEAT):
            spark.catalog.clearCache()
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        cold[name] = round(runs[0], 3)
        times[name] = round(min(runs[1:]) if len(runs) > 1 else runs[0], 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "rows_per_sec": {k: round(n_docs / v, 1) for k, v in times.items() if v > 0},
        "sf": os.path.basename(SF_DIR).replace("sf", ""),
        "documents": n_docs,
        "chars": int(n_chars),
        "bpe_merges": len(learnt["model"].merges),
        "cores": CPUS,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }))


if __name__ == "__main__":
    main()
