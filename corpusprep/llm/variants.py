"""Spelling variants: words one inserted, deleted or replaced code point apart, by a bit-sliced position index.

The index of a block of words holds, for every (position, letter), the set of words with that letter there, one bit
a word. A query reads its letters from left to right and keeps three sets of the block at once, 64 words to a
machine word: those without an error so far, and those with one, either replaced (read at the same position) or
with one letter more than the query (read one position later). One step is a few AND and OR operations per set;
all queries of a block take it together. A word with one letter less is found from its own side.

Blocks are made so that words which can be near meet. For a class L (words of length L, as queries, against words
of length L and L + 1) the letters before and behind a window [low, high) of positions are shared by every pair
whose first difference lies in the window. A word therefore goes, for each window, to the group of its letters
outside it, and a group reports exactly the pairs that first differ inside the window: windows partition the
positions, so no pair is found twice. Each class starts with two windows, its halves; groups above ``GROUP`` words
are cut into two narrower windows, again and again. A window of one position bounds a group by the alphabet
(letters, plus pairs of letters for the longer words), so no group is ever large, whatever the words are. Groups
are packed into blocks of about ``BLOCK`` words; a query starts from the bits of its own group.

A task returns one row per word with neighbours in a group (how many, and the best), never the pairs.

Plan: counts of words (partial sums before the shuffle) are written to the shared folder; group sizes are grouped
counts; hot groups are a written table joined back, which Spark broadcasts only if its size allows; groups meet in
one shuffle of at most four rows a word and two more per cut; one grouped sum per word. Forms are followed to the
root by pointer doubling, whose number of joins is bounded by the logarithm of the greatest count.

Defined cases: null and empty texts have no words; repeated rows count again; a null id is the empty string in the
hash of ``damaged_words``; an empty table gives no rows; extra columns are ignored; words of any length.
"""
from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.sortedgroups import bounds, groups
from corpusprep.session import shared_path

RUN = "[A-Za-z\\u00C0-\\u00FF]"
GROUP = 4096  # words; larger groups are cut
BLOCK = 4096  # words of a block; a larger group is a block of its own
LETTERS = 1 << 18  # letters of a block, likewise
RATIO = 10
U64 = np.uint64


# ---- words ---------------------------------------------------------------------------------------------------


def damaged_words(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, every: int = 31, occurrences: int = 2) -> DataFrame:
    """``word, n``: letter runs with A-Z lower-cased; where ``every`` divides the crc32 h of ``<key>:<run>``, without
    its code point h % length. Words of at least ``least`` letters and ``occurrences`` occurrences."""
    runs = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase), F.lit(f"({RUN}{{{least},}})"))).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


# ---- groups --------------------------------------------------------------------------------------------------


def _group(length: Column, low: Column, high: Column) -> Column:
    """64-bit name of a group: the class, the window and the letters outside it. Groups that share a name by chance
    are only compared together, letter by letter."""
    word = F.col("word")
    return F.xxhash64(length, low, high, F.substring(word, F.lit(1), low), F.substring(word, F.length(word) - length + high + 1, F.length(word)))


def _windows(words: DataFrame) -> DataFrame:
    """Every word in the two halves of its own class and, as the longer one, of the class below."""
    longer = F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")
    rows = words.select("word", "n", longer).withColumn("length", F.length("word") - F.col("longer"))
    middle = F.floor(F.col("length") / 2).cast("int")
    halves = F.array(F.struct(F.lit(0).alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("length").alias("high")))
    rows = rows.select("word", "n", "length", F.inline(halves)).where("low < high")
    return rows.withColumn("group", _group(F.col("length"), F.col("low"), F.col("high")))


def grouped(words: DataFrame, limit: int = GROUP) -> DataFrame:
    """``word, n, length, low, high, group`` such that no group with a window of two positions or more has more than ``limit`` rows."""
    spark, folder = words.sparkSession, shared_path(words.sparkSession, "variants")
    rows, out, step = _windows(words), [], 0
    while True:
        sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("high") - F.col("low")).alias("width"))
        path = f"{folder}/hot-{step}"
        sizes.where((F.col("size") > limit) & (F.col("width") > 1)).select(F.col("group").alias("hot")).write.parquet(path)
        hot = spark.read.parquet(path)
        if hot.isEmpty():
            break
        out.append(rows.join(hot, F.col("group") == F.col("hot"), "left_anti"))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        parts = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
        cut = rows.join(hot, F.col("group") == F.col("hot"), "left_semi").select("word", "n", "length", F.inline(parts))
        cut.withColumn("group", _group(F.col("length"), F.col("low"), F.col("high"))).write.parquet(f"{folder}/cut-{step}")
        rows, step = spark.read.parquet(f"{folder}/cut-{step}"), step + 1
    for part in out:
        rows = part.unionByName(rows)
    return rows


# ---- the index ------------------------------------------------------------------------------------------------


class Index:
    """Bit sets over a block of words: per (position, letter), and per length."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Words as code points ``codes[starts : starts + lengths]``."""
        n = len(lengths)
        self.width = (n + 63) // 64
        self.lengths = lengths
        word = np.repeat(np.arange(n), lengths)
        position = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        letter = codes[np.repeat(starts, lengths) + position]
        self.names, row = np.unique((position << 21) | letter, return_inverse=True)
        self.sets = np.zeros((len(self.names) + 1, self.width), U64)  # the last one is empty
        np.bitwise_or.at(self.sets, (row, word >> 6), U64(1) << (word & 63).astype(U64))

    def having(self, position: int, letters: np.ndarray) -> np.ndarray:
        """For each letter the set of words that have it at ``position``."""
        names = (position << 21) | letters
        at = np.searchsorted(self.names, names)
        known = at < len(self.names)
        known[known] = self.names[at[known]] == names[known]
        return self.sets[np.where(known, at, len(self.names))]

    def of_length(self, length: int) -> np.ndarray:
        flags = np.zeros(self.width * 64, bool)
        flags[: len(self.lengths)] = self.lengths == length
        return np.packbits(flags, bitorder="little").view("<u8")


def range_sets(low: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """Bit sets of the words low <= number < high."""
    base = np.arange(width)[None, :] * 64
    below = lambda edge: np.clip(edge[:, None] - base, 0, 64)
    mask = lambda n: np.where(n >= 64, ~U64(0), (U64(1) << np.minimum(n, 63).astype(U64)) - U64(1))
    return mask(below(high)) & ~mask(below(low))


def neighbours(index: Index, queries: np.ndarray, length: int, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(replaced, longer): bit sets of the words of ``start`` that differ from a query by one replaced letter, or by one
    letter more, and first do so in the query's window. ``queries``: code points, all of ``length``.

    The window of a query that ends at ``length`` also holds the place behind its last letter."""
    right = start.copy()
    replaced, longer = np.zeros_like(right), np.zeros_like(right)
    for i in range(length):
        here, later = index.having(i, queries[:, i]), index.having(i + 1, queries[:, i])
        wrong = right & ~here
        wrong[(i < low) | (i >= high)] = 0
        replaced = (replaced & here) | wrong
        longer = (longer | wrong) & later
        right &= here
    right[high < length] = 0
    same, more = index.of_length(length), index.of_length(length + 1)
    return replaced & same, (longer | right) & more


def _bits(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of every set bit."""
    row, cell = np.nonzero(sets)
    bits = np.unpackbits(sets[row, cell].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], cell[at] * 64 + bit


def _best(word: np.ndarray, near: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its number, how many near words, and that of largest n (ties: first in code-point order)."""
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    starts = bounds(word)
    return word[starts[:-1]], np.diff(starts), near[starts[:-1]]


def block_neighbours(words: list[str], n: np.ndarray, length: np.ndarray, low: np.ndarray, high: np.ndarray, edges: np.ndarray):
    """(word, how many near, best near) by row numbers, for a block of whole groups that begin at ``edges``."""
    raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    index = Index(raw, starts, sizes)
    which = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    found = [(np.zeros(0, np.int64),) * 2]
    asks = np.flatnonzero(sizes == length)
    step = max(64, (1 << 19) // index.width)  # queries at a time: a set of theirs holds 4 MB
    for of_length in np.unique(length[asks]):
        same = asks[length[asks] == of_length]
        for a in range(0, len(same), step):
            q = same[a: a + step]
            letters = raw[starts[q][:, None] + np.arange(of_length)]
            start = range_sets(edges[which[q]], edges[which[q] + 1], index.width)
            replaced, longer = neighbours(index, letters, int(of_length), low[q], high[q], start)
            row, near = _bits(replaced)
            found.append((q[row], near))
            row, near = _bits(longer)
            found += [(q[row], near), (near, q[row])]
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(np.array(words, object), kind="stable")] = np.arange(len(words))
    return _best(*map(np.concatenate, zip(*found, strict=True)), n, rank)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of ``grouped`` -> ``word, n, n_near, best, best_n`` per word and group with neighbours."""
    for batch in groups(batches):
        names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(4)])
        change = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
        size = np.diff(np.concatenate(([0], change, [batch.num_rows])))
        batch = batch.filter(pa.array(np.repeat(size > 1, size)))
        size = size[size > 1]
        edges = np.concatenate(([0], np.cumsum(size)))
        if not len(size):
            continue
        length, low, high, n = (batch.column(c).to_numpy().astype(np.int64) for c in (1, 2, 3, 4))
        letters = np.cumsum(length + 1)
        a = 0
        while a < len(size):  # blocks of whole groups
            full = min(edges[a] + BLOCK, np.searchsorted(letters, letters[edges[a]] + LETTERS))
            b = max(a + 1, int(np.searchsorted(edges, full, side="right")) - 1)
            part = slice(edges[a], edges[b])
            words = batch.column(5).slice(edges[a], edges[b] - edges[a])
            word, many, best = block_neighbours(words.to_pylist(), n[part], length[part], low[part], high[part], edges[a: b + 1] - edges[a])
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(word)), pa.array(n[part][word]), pa.array(many.astype(np.int64)), words.take(pa.array(best)), pa.array(n[part][best])],
                names=["word", "n", "n_near", "best", "best_n"])
            a = b


def near_words(words: DataFrame, limit: int = GROUP) -> DataFrame:
    """``word, n, n_near, best, best_n`` for all ``words`` (``word, n``, distinct): how many other words are one
    insertion, deletion or replacement away, and which of them has the largest n (null if none)."""
    name = ["group", "length", "low", "high"]
    dealt = grouped(words, limit).select(*name, "n", "word").repartition("group").sortWithinPartitions(*name)
    part = dealt.mapInArrow(_search, "word string, n long, n_near long, best string, best_n long")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("best"), F.lit(None).cast("long").alias("best_n"))
    total = part.unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
        F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))).alias("top"))
    return total.select("word", "n", "n_near", F.col("top.word").alias("best"), (-F.col("top.less")).alias("best_n"))


def variants(words: DataFrame, ratio: int = RATIO, limit: int = GROUP) -> DataFrame:
    """``word, form, root, n, n_near, form_n``. A word's form is its best near word if that occurs ``ratio`` times as
    often or more; its root is where the forms end."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")  # forms must grow, or they could go round
    spark, folder = words.sparkSession, shared_path(words.sparkSession, "variant-forms")
    is_form = F.col("best_n") >= ratio * F.col("n")
    near_words(words, limit).select("word", F.when(is_form, F.col("best")).alias("form"), "n", "n_near", F.when(is_form, F.col("best_n")).alias("form_n")).write.parquet(folder)
    out = spark.read.parquet(folder)
    most, least = out.agg(F.coalesce(F.max("n"), F.lit(1)), F.coalesce(F.min("n"), F.lit(1))).first()
    steps = max(0, math.ceil(math.log2(max(1, math.floor(math.log(max(1, most / least), ratio) + 1)))))
    links = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(steps):  # after k rounds a root is 2^k forms away; a chain has at most log(most / least) of them
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return out.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
