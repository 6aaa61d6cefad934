"""Importance resampling against plain Python, and on held-out labels."""
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import resample
from corpusprep.llm.resample import Resampling, features, kth_largest, select


def test_weights_equal_plain_counts(spark, odd, none):
    rows, df = odd
    labels = spark.createDataFrame([(d, d % 2) for d, _ in rows if d is not None and d < 20] + [(None, 1)], "doc_id long, quality int")
    how = Resampling(buckets=512, longest=2, smoothing=2.0)
    got = select(df, labels, F.expr("quality = 1"), how=how).collect()
    bags = []
    for _, t in rows:
        with np.errstate(over="ignore"):
            _, b = features([(t or "").encode()], how)
        bags.append(Counter(b.tolist()))
    good = {d for d, _ in rows if d is not None and d < 20 and d % 2}
    raw, aim = Counter(), Counter()
    for (d, _), b in zip(rows, bags, strict=True):
        raw.update(b)
        if d in good:
            aim.update(b)
    scale = sum(aim.values()) / sum(raw.values())
    ratio = lambda k: math.log((aim[k] + how.smoothing) / (raw[k] * scale + how.smoothing))
    want = sorted((str(d), sum(b.values()), round(sum(n * ratio(k) for k, n in b.items()), 6) if b else None)
                  for (d, _), b in zip(rows, bags, strict=True))
    rounded = lambda x: None if x is None else round(x, 6)
    assert sorted((str(r["doc_id"]), r["n_features"], rounded(r["log_weight"])) for r in got) == want
    scores = sorted((r["score"] for r in got if r["score"] is not None), reverse=True)
    kept = [r["score"] for r in got if r["kept"]]
    assert kept and min(kept) > max([s for s in scores if s not in kept], default=-math.inf)
    assert not any(r["kept"] for r in got if r["score"] is None)
    assert select(none, labels, F.expr("quality = 1")).collect() == []
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] and r["log_weight"] == 0 for r in select(df, nothing, F.expr("quality = 1")).collect() if r["n_features"])


def test_kth_largest_is_exact(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate((rng.normal(0, 1e6, 300), rng.normal(0, 1e-9, 300), np.full(200, 3.25), [1e300, -1e300]))
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").cache()
    order = sorted(values, reverse=True)
    for k in (1, 2, 57, 290, 500, 801, 802):
        assert kth_largest(df, "v", k, digits=3) == order[k - 1]


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fit = labels.where("doc_id % 2 = 0")
    got = select(docs, fit, F.expr("quality = 1 AND toxic = 0"), how=Resampling(fraction=0.85)).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    share = lambda rows: sum(r["kept"] for r in rows) / len(rows)
    good, bad = ([r for r in got if (r["quality"] == 1 and r["toxic"] == 0) == x] for x in (True, False))
    assert share(good) > 0.88 and share(good) > share(bad) + 0.2


def test_query_draws_the_share_of_the_labels(spark):
    from corpusprep.llm.queries import op5_importance_resampling

    sf = "/root/testdata/sf0.1"
    share = spark.read.parquet(f"{sf}/labels.parquet").agg(F.avg(F.expr("int(quality = 1 AND toxic = 0)"))).first()[0]
    drawn, n = op5_importance_resampling(spark, sf).agg(F.sum(F.expr("int(kept)")), F.count("score")).first()
    assert abs(drawn - share * n) <= 1


def test_query_counts_pairs_of_words(spark):
    from corpusprep.llm.queries import op5_importance_resampling

    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r["n_features"] for r in op5_importance_resampling(spark, sf).collect()}
    single = {r["doc_id"]: r["n_features"] for r in select(docs, labels, F.expr("quality = 1 AND toxic = 0")).collect()}
    assert got == {d: max(2 * n - 1, 0) for d, n in single.items()}


@pytest.mark.parametrize("most", [1 << 20, 1000])
def test_every_target_row_is_counted(spark, monkeypatch, most):
    """More than 50,000 of them, by broadcast or by shuffle: the target model is the raw model, all weights are 0."""
    monkeypatch.setattr(resample, "BROADCAST_ROWS", most)
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.hex(F.col("id") % 997)).alias("text"))
    got = select(rows, rows.select("doc_id", F.lit(1).alias("quality")), F.expr("quality = 1"))
    assert got.agg(F.max(F.abs("log_weight"))).first()[0] == 0
