"""Length-bucketed batch layout.

The reference's sampler groups row indices by ``length // bucket_width``, shuffles each bucket
with seed ``seed + epoch``, then loops: on each pass it takes the next chunk of ``batch_size``
from every non-empty bucket in ascending bucket order, skipping short chunks under
``drop_last``. Here:

* F1 ``bucket_id = floor(len / width)``;
* F2 the in-bucket permutation is the order of ``md5('<seed+epoch>:<key>')``; positions come from
  ``ranking`` (a bucket may hold a third of the rows);
* F3 ``chunk = (rn - 1) div batch_size``; pass ``p`` yields chunk ``p`` of each bucket that has
  one, in order of the buckets, so the batch index is the position of (chunk, bucket) among all chunks
  of all buckets. That table has a row per batch; it is numbered by a distributed prefix sum
  (``ranking.numbered``) and joined to the positions, which hold keys only. Nothing of it, not even
  the bucket counts, reaches the driver or the plan;
* F4 ``drop_last`` drops the last, short chunk of each bucket;
* F5 epochs are generated per row (``explode(sequence)``), each with its own seed;
* F6 the real batch count next to the reference's closed-form estimate.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.ranking import NAME, named, numbered, positions, with_positions


def bucket_id(length, width: int = 16) -> Column:
    c = F.col(length) if isinstance(length, str) else length
    return F.floor(c / F.lit(width)).cast("int")


def _shuffled(df: DataFrame, length: str, width: int, seed: int, epochs: int, key: str) -> DataFrame:
    """The rows of every epoch with their bucket, named for ranking."""
    d = df.withColumn("bucket_id", bucket_id(length, width))
    if epochs == 1:
        d = d.withColumn("epoch", F.lit(0))
    else:
        d = d.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    h = F.md5(F.concat((F.lit(seed) + F.col("epoch")).cast("string"), F.lit(":"), F.col(key).cast("string")))
    return named(d.withColumn("_order", h), ["epoch", "bucket_id"], "_order", key)


def bucket_shuffle(df: DataFrame, length: str, width: int = 16, seed: int = 42, epochs: int = 1, key: str = "row_key") -> DataFrame:
    """F1 + F2 (+ F5): ``epoch, bucket_id, rn`` (1-based position inside the shuffled bucket)."""
    rows = _shuffled(df, length, width, seed, epochs, key)
    return with_positions(rows, positions(rows)).drop("_order")


def chunk_order(chunks: DataFrame) -> DataFrame:
    """``bucket_id, chunk, batch_index``: the 0-based place of every chunk in the sampler's output. ``chunks``: the number of
    chunks by ``bucket_id``."""
    each = chunks.where("chunks > 0").select("bucket_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).alias("chunk"))
    return numbered(each.withColumn("_group", F.lit("")), ["_group", "chunk", "bucket_id"], out="batch_index").drop("_group")


def bucket_batches(df: DataFrame, length: str, batch_size: int, width: int = 16, drop_last: bool = False,
                   seed: int = 42, epochs: int = 1, key: str = "row_key") -> DataFrame:
    """every kept row with ``epoch, bucket_id, chunk, batch_index, pos``.

    ``batch_index`` is the 0-based position of the batch in the sampler's output for its epoch (buckets are the same in
    every epoch, so is the order of their chunks); ``pos`` the 0-based position inside the batch. Without a
    length a row is in no bucket: it is left out.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    rows = _shuffled(df.where(F.col(length).isNotNull()), length, width, seed, epochs, key)
    place = F.call_function("div", F.col("rn") - 1, F.lit(batch_size))
    bucket = F.element_at(F.split("_group", "\x1f"), 2).cast("int")
    placed = positions(rows).select(*NAME, "rn", bucket.alias("_bucket"), place.alias("_chunk"), ((F.col("rn") - 1) % F.lit(batch_size)).cast("int").alias("pos"))
    first = F.element_at(F.split("_group", "\x1f"), 1) == "0"
    sizes = placed.where(first).groupBy(F.col("_bucket").alias("bucket_id")).agg(F.count(F.lit(1)).alias("n"))
    chunks = F.floor(F.col("n") / batch_size) if drop_last else F.ceil(F.col("n") / batch_size)
    order = chunk_order(sizes.select("bucket_id", chunks.alias("chunks"))).select(F.col("bucket_id").alias("_bucket"), F.col("chunk").alias("_chunk"), "batch_index")
    placed = placed.join(order, ["_bucket", "_chunk"])  # chunks left out by drop_last have no row here
    placed = placed.select(*NAME, "rn", F.col("_chunk").cast("int").alias("chunk"), "pos", "batch_index")
    return with_positions(rows, placed).drop("_order")


def batch_count(df: DataFrame, length: str, batch_size: int, width: int = 16, drop_last: bool = False) -> DataFrame:
    """real number of batches (per-bucket chunks) and the reference's closed-form estimate."""
    per_bucket = df.groupBy(bucket_id(length, width).alias("bucket_id")).count()
    chunks = F.floor(F.col("count") / batch_size) if drop_last else F.ceil(F.col("count") / batch_size)
    total = F.sum("count")
    est = F.floor(total / batch_size) if drop_last else F.floor((total + batch_size - 1) / batch_size)
    return per_bucket.agg(
        F.coalesce(F.sum(chunks), F.lit(0)).cast("long").alias("n_batches"),
        F.coalesce(est, F.lit(0)).cast("long").alias("batch_count_estimate"),
    )
