"""Packing token sequences with best-fit decreasing.

A document's ids, closed by an end id, are cut into full windows; only the rest of it, shorter than a
window, has to be placed. Rests are placed in decreasing length, each into the tightest window that
still holds it. Open windows are kept by remaining capacity in a segment tree over the capacities, so
the tightest fit is found in log2(window) steps however many windows are open.

Tokenising and placing happen in the task that scans the rows: a task collects up to ``GROUP_DOCS``
rests (or ``GROUP_TOKENS`` tokens), places them, emits their pieces and goes on. Nothing is shuffled,
nothing meets in one task, and memory is bounded. Sequence ids carry the partition number, so they
are unique, and a task that is run again after a lost executor writes its own sequences again.

Defined cases: a null text is an empty one (the end id alone); repeated rows are separate documents; an
empty table gives no pieces.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.tokens import encoder

WINDOW = 1024
END_ID = 0
GROUP_DOCS = 20_000
GROUP_TOKENS = 8_000_000
SEQUENCES_PER_PARTITION = 1 << 36


class CapacityTree:
    """Open windows by remaining capacity (1..size); finds the smallest capacity of at least x."""

    def __init__(self, size: int):
        self.leaves = 1 << (size).bit_length()
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]
        self.any = bytearray(2 * self.leaves)

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        node = self.leaves + capacity
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window with room for ``least``, which is closed."""
        node = self.leaves + least
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        window = self.open[capacity].pop()
        if not self.open[capacity]:
            while node and (node >= self.leaves or not (self.any[2 * node] or self.any[2 * node + 1])):
                self.any[node] = 0
                node >>= 1
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(window of each item, place in it, number of windows); every length is in 1..window."""
    of, offset, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    tree = CapacityTree(window)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = tree.take(n)
        if fit is None:
            fit, used = (window, used), used + 1
        room, at = fit
        of[i], offset[i] = at, window - room
        if room > n:
            tree.add(room - n, at)
    return of, offset, used


def place(tokens: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Documents with so many tokens: (document, start, length, sequence, offset) of every piece, and the number of sequences."""
    full, rest = np.divmod(tokens, window)
    with_rest = np.flatnonzero(rest)
    seq, offset, used = best_fit_decreasing(rest[with_rest], window)
    doc = np.repeat(np.arange(len(tokens)), full)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
    return (np.concatenate((doc, with_rest)), np.concatenate((nth * window, full[with_rest] * window)),
            np.concatenate((np.full(len(doc), window), rest[with_rest])),
            np.concatenate((used + np.arange(len(doc)), seq)), np.concatenate((np.zeros(len(doc), np.int64), offset)), used + len(doc))


def pieces(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base, done = encoder(tokenizer), TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION, 0
        end = np.array([end_id], np.uint32)
        keys: list = []
        sizes: list[int] = []
        cuts: list = []

        def flush() -> pa.RecordBatch:
            nonlocal done
            tokens = np.array(sizes, np.int64)
            doc, start, length, seq, offset, used = place(tokens, window)
            cut = [cuts[d][s // window] for d, s in zip(doc.tolist(), start.tolist(), strict=True)]
            crc = [zlib.crc32(c) for c in cut] if with_ids else cut
            columns = [pa.concat_arrays(keys).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                       pa.array(tokens[doc]), pa.array(seq + base + done), pa.array(offset)]
            if with_ids:
                columns.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in cut], pa.list_(pa.int32())))
            done += used
            keys.clear(), sizes.clear(), cuts.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        total = 0
        for batch in batches:
            for i, t in enumerate(batch.column(1).to_pylist()):
                ids = np.concatenate((encode(t or ""), end)).astype("<u4")
                parts = [ids[s: s + window].tobytes() for s in range(0, len(ids), window)]
                keys.append(batch.column(0).slice(i, 1))
                sizes.append(len(ids))
                cuts.append(parts if with_ids else [zlib.crc32(p) for p in parts])
                total += len(ids)
                if len(sizes) >= GROUP_DOCS or total >= GROUP_TOKENS:
                    yield flush()
                    total = 0
        if sizes:
            yield flush()

    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", ids array<int>" * with_ids
    return df.select(key, text).mapInArrow(scan, schema)


def sequences(placed: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """Packed ids per sequence, padded to the window unless its length is a power of two; needs ``ids`` in ``placed``."""
    rows = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x.ids))
    rows = rows.select("sequence_id", ids.alias("ids"), F.size(ids).alias("n"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    gap = F.when(power, 0).otherwise(window - F.col("n"))
    return rows.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), gap)).alias("ids"), F.col("n").alias("n_ids"))
