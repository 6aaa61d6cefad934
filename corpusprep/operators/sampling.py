"""Seeded shuffles, first-n sampling and the first-n-valid funnel.

The reference shuffles a list in memory and walks it. Here the order is a column: the shuffle key
``md5('<seed>:<row_key>')`` with ``row_key`` breaking ties, so "shuffled order" is a total order
on (skey, row_key) that any executor can evaluate for its own rows.

"Take the first n" then means "find the n-th row in that order". A global ``ORDER BY .. LIMIT n``
merges ``partitions x n`` rows in one task, which does not survive n = 50,000 on 10,000 input
partitions. Instead the n-th row is located by counting: one aggregate counts rows per range of the order (for md5
keys, per four hex digits), the range with the n-th row is counted again in finer ranges, and so on
until it holds a single value. Each step brings a bounded number of range counts to the driver, never
rows or keys. Rows before the cutoff are then selected with a plain filter - no global sort, no
single-task window. Rows that share the cutoff's key are told apart by a hash of their content, so
exactly n rows come out also when keys repeat.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from corpusprep.functions import text as T
from corpusprep.operators.quality import REASONS

HEX_STEP = 4  # hex digits per counting step (65,536 ranges)
CELLS = 4096  # ranges per counting step of a number


def add_shuffle_key(df: DataFrame, seed: int, key: str = "row_key", out: str = "skey") -> DataFrame:
    return df.withColumn(out, T.shuffle_key(seed, key))


@dataclass(frozen=True)
class Cut:
    """The k-th row of an order: its key, how many of the rows with this key belong to the first k, and how many there are."""

    skey: object
    key: object
    take: int
    tied: int

    def before(self, skey: str, key: str) -> Column:
        return _below(skey, self.skey) | (F.col(skey).eqNullSafe(F.lit(self.skey)) & _below(key, self.key))

    def at(self, skey: str, key: str) -> Column:
        return F.col(skey).eqNullSafe(F.lit(self.skey)) & F.col(key).eqNullSafe(F.lit(self.key))


def _below(column: str, value) -> Column:
    """Before ``value`` in ascending order; nulls come first."""
    return F.lit(False) if value is None else F.col(column).isNull() | (F.col(column) < F.lit(value))


def kth_value(df: DataFrame, column: str, k: int, step: int = 1) -> tuple | None:
    """(value, rank among rows with this value, number of such rows) of the k-th smallest value; nulls come first.

    None if there are fewer rows. Strings are counted by prefixes that grow by ``step`` characters, numbers
    by equal ranges.
    """
    text = isinstance(df.schema[column].dataType, T_.StringType)
    c, scope, prefix, low, high = F.col(column), df.select(column), "", None, None
    while True:
        if text:
            cell = F.substring(c, 1, len(prefix) + step)
        elif low is None:
            cell = c.isNotNull().cast("long")
        else:
            share = (c.cast("double") - F.lit(float(low))) / F.lit(float(high - low))  # not exact, but never out of order
            cell = F.floor(share * (CELLS - 1)) if high - low >= CELLS else c - F.lit(low)
        counts = scope.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).collect()
        for r in sorted(counts, key=lambda r: (r["cell"] is not None, r["low"] is not None, r["low"])):
            if k <= r["n"]:
                break
            k -= r["n"]
        else:
            return None
        if r["low"] == r["high"]:
            return r["low"], k, r["n"]
        low, high = r["low"], r["high"]
        if text:
            prefix = r["cell"]
            scope = df.select(column).where(c.startswith(prefix))
        else:
            scope = df.select(column).where(c.between(low, high))


def kth_in_order(df: DataFrame, k: int, skey: str = "skey", key: str = "row_key") -> Cut | None:
    """The k-th (1-based) row of ``df`` by ``(skey, key)``, or None if there are fewer rows.

    Driver traffic is bounded by the number of ranges, never by the data or by k.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    narrow = df.select(skey, key)
    found = kth_value(narrow, skey, k, HEX_STEP)
    if found is None:
        return None
    cs, rank, _ = found
    ck, take, tied = kth_value(narrow.where(F.col(skey).eqNullSafe(F.lit(cs))), key, rank)
    return Cut(cs, ck, take, tied)


def _some_of(rows: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` of the rows, chosen by a hash of their content; equal rows stand in for each other."""
    content = F.md5(F.to_json(F.struct(*(F.col(c) for c in rows.columns)), {"ignoreNullFields": "false"}))
    keyed = rows.withColumn("_content", content)
    h, take, tied = kth_value(keyed, "_content", n, HEX_STEP)
    below, same = keyed.where(F.col("_content") < h), keyed.where(F.col("_content") == h)
    if take < tied:
        same = same.limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(take)))).drop("_copy")
    return below.unionByName(same).drop("_content")


def first_in_order(df: DataFrame, cut: Cut | None, skey: str = "skey", key: str = "row_key") -> DataFrame:
    """The rows up to a cutoff, exactly as many as were asked for."""
    if cut is None:
        return df
    if cut.take == cut.tied:
        return df.where(cut.before(skey, key) | cut.at(skey, key))
    return df.where(cut.before(skey, key)).unionByName(_some_of(df.where(cut.at(skey, key)), cut.take))


def sample_n(df: DataFrame, n: int | None, seed: int = 42, key: str = "row_key", shuffle: bool = True) -> DataFrame:
    """B1: exactly the first ``n`` rows of the seeded shuffle (all rows when n is None or larger).

    ``shuffle=False`` keeps source order, taken as ascending ``key``. The result keeps ``skey``
    so later stages can re-establish the order without re-hashing. Keys may repeat.
    """
    from pyspark import StorageLevel

    keyed = add_shuffle_key(df, seed, key) if shuffle else df.withColumn("skey", F.lit(""))
    if n is None:
        return keyed
    narrow = keyed.select("skey", key).persist(StorageLevel.MEMORY_AND_DISK)  # all counting steps read this, not the texts
    try:
        cut = kth_in_order(narrow, n, "skey", key)
    finally:
        narrow.unpersist()
    return first_in_order(keyed, cut, "skey", key)


def shuffle_positions(df: DataFrame, seed: int = 42, key: str = "row_key") -> DataFrame:
    """B2: every row with its 1-based position in the seeded full shuffle."""
    from corpusprep.operators.ranking import rank_within

    return rank_within(add_shuffle_key(df, seed, key), [], "skey", key, out="position")


def draw_position(seed: int, draw, n: int):
    """1-based position of draw ``j``: ``1 + (first 60 bits of md5('<seed>:draw:<j>') mod n)``."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:draw:"), draw.cast("string"))), 1, 15), 16, 10).cast("long")
    return F.pmod(h, F.lit(n)) + 1


def sample_with_replacement(df: DataFrame, b: int, seed: int = 42, key: str = "row_key") -> DataFrame:
    """Exactly ``b`` draws, uniform with replacement.

    Rows get their 1-based position in the seeded order (see ``ranking``); draw ``j`` picks a hashed position. The draws come from ``range`` and are joined on
    position, so nothing passes through the driver except the row count ``N``.
    """
    from corpusprep.operators.ranking import rank_within

    n = df.count()
    if n == 0:
        raise ValueError("cannot draw from an empty input")
    ranked = rank_within(add_shuffle_key(df, seed, key), [], "skey", key, out="position")
    draws = df.sparkSession.range(b).select(F.col("id").alias("draw"), draw_position(seed, F.col("id"), n).alias("position"))
    return draws.join(ranked, "position", "inner")


@dataclass
class FirstN:
    """Result of the first-n-valid scan: selected rows (lazy), funnel (lazy), and the cutoff.

    ``narrow`` is the cached ``(row_key, skey, reason)`` frame the cutoff search and the funnel
    read; ``release()`` drops it once the results are written.
    """

    selected: DataFrame
    funnel: DataFrame
    cutoff: Cut | None
    narrow: DataFrame | None = None

    def release(self) -> None:
        if self.narrow is not None:
            self.narrow.unpersist()


def first_n_valid(classified: DataFrame, n: int, seed: int = 42, key: str = "row_key") -> FirstN:
    """B3 + E3: walk the seeded shuffle and stop at the n-th valid row.

    ``classified`` carries ``reason`` (null = valid). Rows up to and including the cutoff are
    "seen"; when fewer than n rows are valid, every row is seen. The texts are parsed once: the
    cutoff search (two small jobs) and the funnel read a cached narrow frame of about 50 bytes a
    row; only the selected rows go back to the texts.
    """
    from pyspark import StorageLevel

    keyed = add_shuffle_key(classified, seed, key)
    narrow = keyed.select(key, "skey", "reason").persist(StorageLevel.MEMORY_AND_DISK)
    cut = kth_in_order(narrow.where(F.col("reason").isNull()), n, "skey", key)
    r = F.col("reason")
    valid = F.count_if(r.isNull())
    if cut is None:
        window, ok, seen = narrow, valid, F.count(F.lit(1))
    else:  # of rows that share the cutoff's key, the valid ones come first
        window, ok, seen = narrow.where(cut.before("skey", key)), valid + cut.take, F.count(F.lit(1)) + cut.take
    funnel = window.agg(
        ok.alias("n"),
        seen.alias("seen"),
        F.count_if(r.isNotNull()).alias("filtered"),
        ok.alias("candidates"),
        ok.alias("selected"),
        *[F.count_if(r == x).alias(f"filtered_{x}") for x in REASONS],
    )
    selected = first_in_order(keyed.where(r.isNull()), cut, "skey", key)
    return FirstN(selected=selected, funnel=funnel, cutoff=cut, narrow=narrow)
