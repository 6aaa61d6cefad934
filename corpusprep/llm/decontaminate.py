"""Benchmark decontamination with suffix arrays over the training text.

Every task cuts its rows into shards (runs of whole texts) and builds a suffix array over the words of
each shard; every suffix of every benchmark item is then binary-searched in it. The hits give the
occurrences of each window, joined along diagonals into longest verbatim matches with their places.
A suffix that cannot hold the shortest window - one of its first words is in no benchmark item - is
left out of the array: it would never be found.

The documents are scanned once; nothing is shuffled. The benchmark travels to the tasks in blocks of
at most ``BLOCK_BYTES`` of text. Its size is measured first: usually there is one block; with more, the
rows with what was found so far are checkpointed between blocks, so a task holds one block at a time.

Defined cases: a null text has no words; an item without words matches nothing; a null item id counts
as the id ``''``; rows that share an id are one item in the counts; repeated documents get a row each;
an empty benchmark leaves every document clean.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.textbuf import ALNUM, U64, Words, covered, runs, text_bytes
from corpusprep.session import ensure_checkpoint_dir

WINDOW = 13
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 2 << 20
FOUND = "hits array<int>, items array<string>, matches array<struct<item_id:string,doc_start:int,item_start:int,n_words:int>>"


@dataclass
class TestBlock:
    """Suffixes of a block of items, ready to be searched."""

    ids: list[str]
    vocabulary: np.ndarray  # sorted word hashes; a word's code is its place + 1
    item: np.ndarray  # of each window
    place: np.ndarray  # first word of the window in its item
    width: np.ndarray  # words in the window
    low: list[np.ndarray]  # packed codes, padded with zeros ...
    high: list[np.ndarray]  # ... and with ones
    bits: int

    @property
    def shortest(self) -> int:
        return int(self.width.min()) if len(self.width) else 0


def pack(codes: np.ndarray, starts: np.ndarray, width: np.ndarray, bits: int, fill: int) -> list[np.ndarray]:
    """The first WINDOW codes of each suffix as a few 64-bit keys; places from ``width`` on hold ``fill``."""
    per = 64 // bits
    keys = []
    for first in range(0, WINDOW, per):
        key = np.zeros(len(starts), U64)
        for k in range(first, first + per):
            inside = (k < width) & (k < WINDOW)
            code = np.where(inside, codes[np.minimum(starts + k, len(codes) - 1)], fill if k < WINDOW else 0)
            key = (key << U64(bits)) | code.astype(U64)
        keys.append(key)
    return keys


def prepare(items: list[tuple[str, bytes]]) -> TestBlock | None:
    """None if no item has a word."""
    with np.errstate(over="ignore"):
        w = Words([t for _, t in items], ALNUM, b" ", lower=True)
        hashes = w.hashes()
    if not len(hashes):
        return None
    vocabulary, codes = np.unique(hashes, return_inverse=True)
    codes = codes + 1
    n = np.diff(w.first)
    left = w.first[1:][w.doc] - np.arange(len(codes))  # words from here to the item's end
    whole = np.minimum(n, WINDOW)[w.doc]
    starts = np.flatnonzero(left >= whole)
    width, bits = whole[starts], max(1, int(len(vocabulary)).bit_length())
    return TestBlock([i for i, _ in items], vocabulary, w.doc[starts], starts - w.first[w.doc[starts]], width,
                     pack(codes, starts, width, bits, 0), pack(codes, starts, width, bits, (1 << bits) - 1), bits)


def search(keys: list[np.ndarray], probe: list[np.ndarray], right: bool) -> np.ndarray:
    """Binary search of every probe in the sorted multi-key array."""
    lo, hi = np.zeros(len(probe[0]), np.int64), np.full(len(probe[0]), len(keys[0]), np.int64)
    for _ in range(max(1, len(keys[0])).bit_length()):
        open_, mid = lo < hi, (lo + hi) >> 1
        at = np.minimum(mid, len(keys[0]) - 1)
        below, same = np.zeros(len(at), bool), np.ones(len(at), bool)
        for k, p in zip(keys, probe, strict=True):
            v = k[at]
            below |= same & (v < p)
            same &= v == p
        up = open_ & (below | same if right else below)
        lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
    return lo


def occurrences(texts: list[bytes], block: TestBlock) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of the shard, and (first word, window) of every occurrence of a window."""
    w = Words(texts, ALNUM, b" ", lower=True)
    hashes = w.hashes()
    place = np.searchsorted(block.vocabulary, hashes)
    place[place == len(block.vocabulary)] = 0
    codes = np.where(block.vocabulary[place] == hashes, place + 1, 0) if len(hashes) else place
    stop = np.union1d(np.flatnonzero(codes == 0), w.first)  # where a run of known words ends
    at = np.flatnonzero(codes > 0)
    left = stop[np.searchsorted(stop, at, side="right")] - at if len(at) else at
    at, left = at[left >= block.shortest], left[left >= block.shortest]
    none = np.zeros(0, np.int64)
    if not len(at):
        return w, none, none
    keys = pack(codes, at, left, block.bits, 0)
    order = np.lexsort(keys[::-1])
    array, keys = at[order], [k[order] for k in keys]
    low, high = search(keys, block.low, False), search(keys, block.high, True)
    n = high - low
    window = np.repeat(np.arange(len(n)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return w, array[low[window] + inside], window


def _ranges(mask: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()


def scan_shard(texts: list[bytes], block: TestBlock) -> tuple[np.ndarray, dict[int, tuple]]:
    """Words of each text; for texts with a hit: (word ranges, item ids, longest matches)."""
    w, at, window = occurrences(texts, block)
    hit = np.zeros(len(w.doc), bool)
    for width in np.unique(block.width[window]):
        hit |= covered(at[block.width[window] == width], int(width), len(hit))
    found: dict[int, tuple] = {}
    item, width = block.item[window], block.width[window]
    order = np.lexsort((at, at - block.place[window], item, w.doc[at]))
    at, item, width, place = at[order], item[order], width[order], block.place[window][order]
    doc = w.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (np.diff(at) != 1) | (np.diff(place) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    for f, l in zip(first, last, strict=True):
        row = int(doc[f])
        begin = int(w.first[row])
        ranges, ids, matches = found.setdefault(row, ([], set(), []))
        if not ids:
            ranges.extend(_ranges(hit[begin: w.first[row + 1]]))
        ids.add(block.ids[item[f]])
        matches.append((block.ids[item[f]], int(at[f]) - begin, int(place[f]), int(at[l] + width[l] - at[f])))
    return np.diff(w.first), found


def _join(old: list[int] | None, new: list[int], n: int) -> list[int]:
    if not old:
        return new
    mask = np.zeros(n, bool)
    for r in (old, new):
        for a, b in zip(r[::2], r[1::2], strict=True):
            mask[a:b] = True
    return _ranges(mask)


def find(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` as columns ``c0..`` in their order, and ``n_words, hits`` (flat word ranges), ``items, matches``."""
    spark = df.sparkSession
    tests = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    place, width = df.columns.index(text), len(df.columns)
    out = df.toDF(*(f"c{i}" for i in range(width))).selectExpr(
        "*", "0L AS n_words", "CAST(array() AS array<int>) AS hits", "CAST(array() AS array<string>) AS items",
        "CAST(array() AS array<struct<item_id:string,doc_start:int,item_start:int,n_words:int>>) AS matches")
    for number in range(blocks):
        part = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number)
        block = spark.sparkContext.broadcast(prepare([(r[0], r[1].encode()) for r in part.collect()]))  # of a measured size
        out = out.mapInArrow(_scanner(block, place, width), out.schema)
        if number + 1 < blocks:
            ensure_checkpoint_dir(spark)
            out = out.checkpoint()
    return out


def _scanner(block, place: int, width: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = block.value if block.value is not None else TestBlock([], np.zeros(1, U64), *[np.zeros(0, np.int64)] * 3, [], [], 1)
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(place))
                for a, b in runs(texts, SHARD_BYTES):
                    part = batch.slice(a, b - a)
                    if len(tests.width):
                        n_words, found = scan_shard(texts[a:b], tests)
                    else:
                        n_words, found = np.diff(Words(texts[a:b], ALNUM, b" ", lower=True).first), {}
                    was = [part.column(width + i).to_pylist() for i in (1, 2, 3)]
                    for row, (ranges, ids, matches) in found.items():
                        was[0][row] = _join(was[0][row], ranges, int(n_words[row]))
                        was[1][row] = sorted({*(was[1][row] or []), *ids})
                        was[2][row] = (was[2][row] or []) + [
                            dict(zip(("item_id", "doc_start", "item_start", "n_words"), m, strict=True)) for m in matches]
                    types = [part.schema.field(width + i).type for i in (1, 2, 3)]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:width], pa.array(n_words, pa.int64()), *(pa.array(v, t) for v, t in zip(was, types, strict=True))],
                        names=part.schema.names)

    return scan


def judge(found: DataFrame, least: tuple[int, int] = (1, 20)) -> DataFrame:
    """Adds ``n_hit, n_items, contaminated``: hit words are at least the share ``least`` (a fraction) of all."""
    n_hit = F.aggregate("hits", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign")),
                        lambda a, x: F.struct((a.sum + a.sign * x).alias("sum"), (-a.sign).alias("sign")), lambda a: a.sum)
    return (found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (least[1] * F.col("n_hit") >= least[0] * F.col("n_words"))))


def remove(df: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``df``, all its columns, without the contaminated rows."""
    return judge(find(df, items, text)).where("NOT contaminated").select(*(f"c{i}" for i in range(len(df.columns)))).toDF(*df.columns)
