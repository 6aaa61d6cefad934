"""Reject rules (D1-D3) and the full-scan reason counts.

One ``CASE`` column names the first failing rule in the fixed order
empty -> ratio -> src_short -> src_long -> tgt_short -> tgt_long; a valid row has a null reason.
Extra rules are ``(name, Column)`` pairs appended after the built-in ones.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.config import FilterConfig
from corpusprep.functions import text as T

# Reject reasons in evaluation order.
REASONS = ("empty", "ratio", "src_short", "src_long", "tgt_short", "tgt_long")


def ratio_ok(src_len, tgt_len, ratio_max: float) -> Column:
    """``max(s, t) / min(s, t) <= ratio_max``, false when either side is empty (checked first)."""
    s, t = F.col(src_len) if isinstance(src_len, str) else src_len, F.col(tgt_len) if isinstance(tgt_len, str) else tgt_len
    lo = F.least(s, t)
    return F.when(lo <= 0, F.lit(False)).otherwise(
        (F.greatest(s, t).cast("double") / lo.cast("double")) <= F.lit(float(ratio_max))
    )


def reject_reason(cfg: FilterConfig, src_len="src_len", tgt_len="tgt_len",
                  extra_rules: Sequence[tuple[str, Column]] = (), word_caps: bool = False) -> Column:
    s = F.col(src_len) if isinstance(src_len, str) else src_len
    t = F.col(tgt_len) if isinstance(tgt_len, str) else tgt_len
    c = (
        F.when((s == 0) | (t == 0), F.lit("empty"))
        .when(~ratio_ok(s, t, cfg.ratio_max), F.lit("ratio"))
        .when(s < cfg.tokens_min, F.lit("src_short"))
        .when(s > cfg.tokens_max, F.lit("src_long"))
        .when(t < cfg.tokens_min, F.lit("tgt_short"))
        .when(t > cfg.tokens_max, F.lit("tgt_long"))
    )
    if word_caps:  # C7: optional, off by default as in the reference
        c = c.when(s > cfg.src_max_words, F.lit("src_cap")).when(t > cfg.tgt_max_words, F.lit("tgt_cap"))
    for name, failed in extra_rules:
        c = c.when(failed, F.lit(name))
    return c


def classify(df: DataFrame, cfg: FilterConfig, src: str = "src", tgt: str = "tgt",
             extra_rules: Sequence[tuple[str, Column]] = (), word_caps: bool = False) -> DataFrame:
    """Lengths plus ``reason`` (null = valid).

    The two word counts are generated from a one-element array. Catalyst moves no filter and copies no
    expression below a generator, so the texts are split once, however often lengths and reason are used.
    """
    lens = F.struct(T.word_count(src).alias("src_len"), T.word_count(tgt).alias("tgt_len"))
    measured = df.select("*", F.explode(F.array(lens)).alias("_lengths")).select(*df.columns, "_lengths.src_len", "_lengths.tgt_len")
    return measured.withColumn("reason", reject_reason(cfg, "src_len", "tgt_len", extra_rules, word_caps))


def filter_valid(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull())


def project_clean(valid: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """``idx, src, tgt`` of valid rows: texts stripped, ``idx`` = content hash of the stripped pair."""
    s, t = T.strip_text(src), T.strip_text(tgt)
    return valid.select(T.content_idx(s, t).alias("idx"), s.alias("src"), t.alias("tgt"))


def reason_count_columns() -> list[Column]:
    r = F.col("reason")
    cols = [F.count(F.lit(1)).alias("seen"), F.count_if(r.isNull()).alias("ok")]
    cols += [F.count_if(r == x).alias(x) for x in REASONS]
    return cols


def reason_counts(classified: DataFrame) -> DataFrame:
    """Full-scan classification: one row ``seen, ok, empty, ratio, src_short, ...``."""
    return classified.agg(*reason_count_columns())
