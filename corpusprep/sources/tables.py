"""Pair views over the given Parquet tables.

There is no bilingual table, so two views stand in for a parallel corpus:

* ``pairs`` from ``documents``: lines 1 and 2 of a text are a pair, lines 3 and 4 the next, to the end; an
  odd last line is paired with ''. Row key ``<doc_id>:<pair number>``.
* ``turn_pairs`` from ``conversations``: a user turn and the assistant turn that follows it in the same
  conversation; row key ``<conv_id>:<turn>``. System turns, and user turns without such an answer, are
  in no pair. Built with an equi-join on ``(conv_id, turn + 1)`` rather than a window over the
  conversation, so a very long one is split by the join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


#: Session setting: deal rows of the tables out to so many partitions after the scan. Unset by default; for
#: tables stored as a few row groups, which a scan cannot split over all cores.
SCAN_PARTITIONS = "corpusprep.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A given table, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    parts = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df


def documents_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_key, src, tgt, lang, source``: all lines of ``documents``, two by two."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    n = F.ceil(F.size("lines") / 2).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        i.alias("no"), F.get("lines", 2 * i).alias("src"), F.coalesce(F.get("lines", 2 * i + 1), F.lit("")).alias("tgt")))
    rows = d.withColumn("lines", lines).select("doc_id", "lang", "source", F.explode(pairs).alias("p"))
    return rows.select(F.concat_ws(":", "doc_id", "p.no").alias("row_key"), "p.src", "p.tgt", "lang", "source")


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn ``t`` paired with the assistant turn ``t + 1`` of the same conversation."""
    c = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    u = c.where(F.col("role") == "user").select("conv_id", F.col("turn").alias("u_turn"), F.col("text").alias("src"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("u_turn"), F.col("text").alias("tgt"))
    return u.join(a, ["conv_id", "u_turn"], "inner").select(
        F.concat_ws(":", "conv_id", "u_turn").alias("row_key"),
        F.coalesce("src", F.lit("")).alias("src"),
        F.coalesce("tgt", F.lit("")).alias("tgt"),
    )
