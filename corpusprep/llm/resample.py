"""Quality selection by importance resampling.

Two bags of hashed word n-grams are modelled: the target's (texts labelled good) and the raw corpus's. A text's log weight is the sum of log(target / raw) over its n-grams. Adding Gumbel noise to
the log weights and taking the k largest draws k texts without replacement, in proportion to their weights.

The raw model counts every text, the target model every text of a target row: texts and labels are joined by
a hash of the key, by broadcast up to a million target rows and by a shuffle beyond. Counts leave a task as one row
per bucket; the models have ``buckets`` entries. k is a share of the texts that have a word; by default
the share of target rows among the labelled ones. The k-th largest score is found by its digits, from
counts, so no ranking passes through one task.

Defined cases: a null text or one without words has no weight and is never drawn; rows tied with the
k-th largest score are all drawn; repeated rows have the same noise; without labels all weights are 0
and everything is kept; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.textbuf import ALNUM, U64, Words, mix, runs, text_bytes
from corpusprep.session import ensure_checkpoint_dir

BROADCAST_ROWS = 1 << 20  # hashes of target rows (8 MB for 77,722 of them on check_l) that are sent to every task; more of them are joined by a shuffle


@dataclass(frozen=True)
class Resampling:
    """``longest``: words of the longest n-gram; ``smoothing``: pseudo-count of every bucket in a model of the target's size; ``fraction``: share of texts drawn (None: share of target rows among labelled ones)."""

    longest: int = 1
    buckets: int = 1 << 16
    smoothing: float = 50.0
    fraction: float | None = None
    seed: int = 1


def features(texts: list[bytes], how: Resampling) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram of 1 to ``longest`` words."""
    w = Words(texts, ALNUM, b" ", lower=True)
    one = w.hashes()
    at, gram = np.arange(len(one)), one
    doc, bucket = [w.doc], [one % U64(how.buckets)]
    for n in range(2, how.longest + 1):
        fits = at[at + n <= w.first[1:][w.doc[at]]]
        gram = gram[np.searchsorted(at, fits)] * U64(0xC2B2AE3D27D4EB4F) + one[fits + n - 1]
        at = fits
        doc.append(w.doc[at])
        bucket.append(mix(gram) % U64(how.buckets))
    return np.concatenate(doc), np.concatenate(bucket).astype(np.int64)


def _counter(how: Resampling):
    buckets = how.buckets

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, aim = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        with np.errstate(over="ignore"):
            for batch in batches:
                chosen = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                texts = text_bytes(batch.column(1))
                for a, b in runs(texts):
                    doc, bucket = features(texts[a:b], how)
                    raw += np.bincount(bucket, minlength=buckets)
                    aim += np.bincount(bucket[chosen[a:b][doc]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(aim[seen])], names=["bucket", "raw", "aim"])

    return scan


def _scorer(ratio, how: Resampling):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(2))
                for a, b in runs(texts):
                    doc, bucket = features(texts[a:b], how)
                    n = np.bincount(doc, minlength=b - a)
                    weight = np.bincount(doc, ratio.value[bucket], minlength=b - a)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(a, b - a).columns[:2], pa.array(n), pa.array(weight, mask=n == 0)], names=["key", "id", "n", "log_weight"])

    return scan


def kth_largest(df: DataFrame, column: str, k: int, digits: int = 12) -> float | None:
    """The k-th largest value of a double column, exactly: counts of equal ranges, the chosen one cut again until it holds one value."""
    if k <= 0:
        return None
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k >= n:
        return low
    parts, rest = 1 << digits, df.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    while low < high:
        step = (high - low) / parts
        cell = F.least(F.floor((F.col("v") - low) / step) if step > 0 else F.lit(0), F.lit(parts - 1)).alias("cell")
        rows = rest.where((F.col("v") >= low) & (F.col("v") <= high)).groupBy(cell).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy(F.desc("cell")).collect()
        for r in rows:  # at most ``parts`` rows
            if k <= r["n"]:
                if (low, high) == (r["low"], r["high"]):  # the range can't be cut any finer
                    return _among(rest, low, high, k)
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return low


def _among(values: DataFrame, low: float, high: float, k: int) -> float:
    rows = values.where((F.col("v") >= low) & (F.col("v") <= high)).groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("v")).collect()
    for r in rows:  # neighbouring doubles: a handful
        if k <= r["n"]:
            return r["v"]
        k -= r["n"]
    return low


def select(df: DataFrame, labels: DataFrame, target: Column, key: str = "doc_id", text: str = "text", how: Resampling | None = None) -> DataFrame:
    """One row per input row: ``key, n_features, log_weight, score, kept``. ``target`` is a condition on ``labels``, which shares ``key``."""
    how = how or Resampling()
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    good = F.coalesce(target, F.lit(False))
    labelled, n_good = labels.agg(F.count(F.lit(1)), F.sum(good.cast("long"))).first()
    chosen = labels.where(good & F.col(key).isNotNull()).select(F.xxhash64(F.lit(how.seed), F.col(key)).alias("id"))
    rows = df.select(F.col(key).alias("key"), F.xxhash64(F.lit(how.seed), F.col(key)).alias("id"), F.col(text).alias("text"))
    chosen = chosen.distinct().withColumn("target", F.lit(1))
    chosen = chosen.hint("broadcast") if (n_good or 0) <= BROADCAST_ROWS else chosen.hint("merge")  # the same rows; the second shuffles the texts
    marked = rows.select("id", "text").join(chosen, "id", "left").select("target", "text")
    counts = (marked.mapInArrow(_counter(how), "bucket long, raw long, aim long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("aim").alias("aim")).toArrow())  # one row per bucket
    raw, aim = np.zeros(how.buckets), np.zeros(how.buckets)
    at = counts["bucket"].to_numpy()
    raw[at], aim[at] = counts["raw"].to_numpy(), counts["aim"].to_numpy()
    # the raw model is brought to the target's size, so that the same pseudo-counts smooth both alike
    ratio = np.log((aim + how.smoothing) / (raw * (aim.sum() / max(raw.sum(), 1)) + how.smoothing)) if aim.any() else np.zeros(how.buckets)
    kind = df.schema[key].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(spark.sparkContext.broadcast(ratio), how), f"key {kind}, id long, n long, log_weight double")
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), "id"), 11).cast("double") + 0.5) / float(1 << 53)
    scored = scored.withColumn("score", F.col("log_weight") - F.log(-F.log(uniform))).checkpoint()
    share = how.fraction if how.fraction is not None else (n_good / labelled if labelled and n_good else 1.0)
    cut = kth_largest(scored, "score", round(share * scored.where("score IS NOT NULL").count()))
    kept = F.coalesce(F.col("score") >= F.lit(cut), F.lit(False)) if cut is not None else F.lit(False)
    return scored.select(F.col("key").alias(key), F.col("n").alias("n_features"), "log_weight", "score", kept.alias("kept"))
