"""Scoring of token predictions.

Input: scored tokens, one row per position with a ``scores`` vector and an integer ``target``.
Both metrics are built-in array expressions plus one global (or grouped) average.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def argmax(scores) -> Column:
    """0-based index of the first maximum."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return F.array_position(s, F.array_max(s)) - 1


def token_nll(scores, target) -> Column:
    """Stable softmax cross-entropy: ``log(sum(exp(x - max))) + max - x[target]``."""
    s = F.col(scores) if isinstance(scores, str) else scores
    t = F.col(target) if isinstance(target, str) else target
    m = F.array_max(s)
    lse = F.log(F.aggregate(F.transform(s, lambda x: F.exp(x - m)), F.lit(0.0).cast("double"), lambda a, x: a + x)) + m
    return lse - F.element_at(s, (t + 1).cast("int"))


def scored_tokens(embeddings: DataFrame) -> DataFrame:
    """Treat each embedding as a score vector over ``size(embedding)`` classes; the target is
    ``label`` wrapped into that range."""
    s = F.col("embedding").cast("array<double>")
    return embeddings.select(
        F.col("vec_id").alias("seq_id"),
        s.alias("scores"),
        F.pmod(F.col("label"), F.size("embedding")).alias("target"),
    ).where(F.size("scores") > 0)


def token_accuracy(scored: DataFrame, group_cols: list[str] | None = None, places: int = 9) -> DataFrame:
    """E5: mean of ``argmax(scores) == target``."""
    hit = (argmax("scores") == F.col("target")).cast("double")
    g = scored.groupBy(*(group_cols or []))
    return g.agg(F.count(F.lit(1)).alias("n_tokens"), F.round(F.avg(hit), places).alias("token_accuracy"))


def mean_nll(scored: DataFrame, group_cols: list[str] | None = None, places: int = 9) -> DataFrame:
    """Mean cross-entropy over tokens."""
    g = scored.groupBy(*(group_cols or []))
    return g.agg(F.count(F.lit(1)).alias("n_tokens"), F.round(F.avg(token_nll("scores", "target")), places).alias("mean_nll"))
