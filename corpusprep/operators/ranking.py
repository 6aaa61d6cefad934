"""Positions of rows in an order, whatever the keys.

``row_number() OVER (PARTITION BY g ORDER BY h, key)`` puts a whole group in one task. Length buckets are few and
uneven, a global position is the extreme case of a single group, source order has one hash for all rows, and a key
may hold half of them. Here only keys are ordered:

1. Rows are named by (group, hash, key, content hash); equal rows are one name with a count, combined before the
   shuffle. So names are distinct, and a hot key is as many names as it has different rows.
2. Names are range-partitioned on that whole order and sorted; a stream numbers each group inside its partition. The
   result is written to the shared folder, so the partitions stay what they are.
3. Counts per (partition, group), at most one row more a partition than there are groups, give each its offset.
4. Positions are joined to the rows, which are shuffled once, by name.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAME = ["_group", "_h", "_key", "_content"]


def group_name(*columns: str | Column) -> Column:
    """One string per group; its order among groups does not matter."""
    told = lambda c: F.coalesce(c.cast("string"), F.lit("\x00"))
    return F.concat_ws("\x1f", *(told(F.col(c) if isinstance(c, str) else c) for c in columns)) if columns else F.lit("")


def content_hash(columns: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*(F.col(c) for c in columns)), {"ignoreNullFields": "false"}))


def numbered(names: DataFrame, by: list[str], group: str = "_group", count: str | None = None, out: str = "start", partitions: int | None = None) -> DataFrame:
    """``names`` with ``out``: how many rows of the same group stand before, in the order ``by`` (which begins with the
    group). ``count``: a column that says how many rows a name stands for.

    Eager: the numbered names are written to the shared folder. ``partitions``: of the range partitioning;
    by default as many as shuffles have.
    """
    from corpusprep.session import shared_path, ship_package

    spark = names.sparkSession
    ship_package(spark)
    place, size = names.columns.index(group), None if count is None else names.columns.index(count)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(place)
            rows = np.ones(n, np.int64) if size is None else batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(rows)
            change = np.flatnonzero(pc.not_equal(g.slice(1), g.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1
            begins = np.concatenate(([0], change))
            base = np.repeat(ends[begins] - rows[begins], np.diff(np.append(begins, n)))
            local = ends - rows - base
            if last is not None and g[0].as_py() == last:
                local[: change[0] if len(change) else n] += before
            before, last = int(local[-1] + rows[-1]), g[n - 1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(local)], names=[*batch.schema.names, "_part", "_local"])

    dealt = names.repartitionByRange(*((partitions,) if partitions else ()), *by).sortWithinPartitions(*by)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names.schema)
    path = shared_path(spark, "numbered")
    dealt.mapInArrow(number, f"{fields}, _part int, _local long").write.parquet(path)
    placed = spark.read.parquet(path)
    rows = F.count(F.lit(1)) if count is None else F.sum(count)
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(group, "_part").agg(rows.alias("_rows")).select(group, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    return placed.join(offsets, [group, "_part"]).withColumn(out, F.col("_offset") + F.col("_local")).drop("_part", "_local", "_offset", "_rows")


def named(df: DataFrame, groups: list[str], h: str, key: str) -> DataFrame:
    """The rows with the columns of ``NAME``."""
    return df.select("*", group_name(*groups).alias("_group"), F.col(h).alias("_h"), F.col(key).alias("_key"), content_hash(df.columns).alias("_content"))


def positions(rows: DataFrame, out: str = "rn", partitions: int | None = None) -> DataFrame:
    """``NAME`` and the 1-based position of every row of ``named`` in its group; equal rows have consecutive ones."""
    names = rows.groupBy(*NAME).agg(F.count(F.lit(1)).alias("_n"))
    placed = numbered(names, NAME, count="_n", partitions=partitions)
    return placed.select(*NAME, F.explode(F.sequence(F.col("start") + 1, F.col("start") + F.col("_n"))).alias(out))


def with_positions(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The rows of ``named`` with the further columns of ``placed`` (rows by ``NAME``), which replace any of the same name. Equal rows are carried as one, which the
    join multiplies again, so none of them is held twice and a group of copies is no hot key of the shuffle."""
    more = [c for c in placed.columns if c not in NAME]
    own = [c for c in rows.columns if c not in NAME and c not in more]
    once = rows.groupBy(*NAME).agg(F.first(F.struct(*(F.col(c) for c in own))).alias("_row"))
    same = None
    for c in NAME:
        equal = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        same = equal if same is None else same & equal
    return once.alias("a").join(placed.alias("b"), same).select(*(F.col(f"a._row.{c}").alias(c) for c in own), *(F.col(f"b.{c}") for c in more))


def rank_within(df: DataFrame, group_cols: list[str], h: str, key: str, out: str = "rn", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in its group, ordered by ``(h, key)``, ties by content."""
    rows = named(df, group_cols, h, key)
    return with_positions(rows, positions(rows, out, partitions))
