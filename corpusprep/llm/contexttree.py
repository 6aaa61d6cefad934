"""Language-model scoring by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z lower-cased, followed by one end symbol; before its first byte stand ``depth``
edge symbols. (0xFF is both: no UTF-8 text holds it.) A byte is eight binary decisions; a decision's node is
(the last d bytes, the bits of the byte so far), for every depth d from 0 to ``depth``. A node holds how often
training went on with 0 and with 1; its Krichevsky-Trofimov estimate is Pe, and its weighted probability
Pw = (Pe + product of the children's Pw) / 2, at the greatest depth Pw = Pe. The probability of a bit mixes the
estimates of all depths on its path by the posterior weights Pe / (2 Pw). A context that training never saw has
no node: the estimate of the longest seen one holds there, for 0 and 1 alike, so bits still sum to one.

Plan. All figures follow from counts of (depth + 1)-grams, so nothing but grams is ever gathered:

1. One scan counts grams; those of texts that are only scored come with a training count of 0, so that every
   gram of every text has a row and scoring meets no unknown one.
2. Grams are dealt out by their two latest context bytes and sorted; a task streams over groups of three context
   bytes (65,536 grams of each deeper byte at most) and folds the depths below, emitting one row a node. The
   depths 2, 1 and 0 are ordinary grouped sums (at most 256 * 256 * 255 rows).
3. Top down: the mixture so far is joined to the next depth; a second stream over the grams gives each its
   log-probability.
4. One scan scores all texts. The most frequent grams and words, at most ``BROADCAST_GRAMS`` and
   ``BROADCAST_WORDS`` of them, are broadcast; what a text has beside them leaves the scan as (row, gram, count)
   and (row, word, count) and meets the rest of the tables in a shuffled join. Rare keys have no skew.

The word counts of the unigram base are exact, by the words themselves.

Defined cases: a null text is an empty one (one end); repeated rows each get a row and each count; a null key is
the empty string where its hash decides; without any training row every bit has probability 1/2; extra columns
are ignored. Memory follows the longest text by a small factor; grams are made in slices.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.sortedgroups import groups
from corpusprep.llm.textbuf import BY_SPACE, LOWER, Words, runs, text_bytes
from corpusprep.session import shared_path

DEPTH = 5
UPPER = 2  # depths 0 to UPPER are summed by Spark
EDGE = 0xFF
SLICE = 1 << 21  # positions at a time, half as many when texts are scored
BROADCAST_GRAMS = 1 << 20  # of 16 bytes
BROADCAST_WORDS = 1 << 18
LN2 = float(np.log(2))
NODE = "n0 long, n1 long, child double"


# ---- grams ---------------------------------------------------------------------------------------------------


def grams(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(grams, texts, how many grams of each of these) of every byte and end of the texts, in slices. A gram is an
    integer: the latest context byte first, the earliest last, then the byte itself, so that the grams of a
    context are one range."""
    edge = bytes([EDGE])
    pad = edge * depth
    buf = LOWER[np.frombuffer(b"".join(pad + t + edge for t in texts), np.uint8)]
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + depth + 1
    end = np.cumsum(size)
    begin = end - size + depth
    real = np.ones(len(buf), bool)
    real[(begin[:, None] - np.arange(1, depth + 1)).ravel()] = False
    for a in range(depth, len(buf), SLICE):
        b = min(a + SLICE, len(buf))
        key = np.zeros(b - a, np.int64)
        for d in (*range(1, depth + 1), 0):
            key <<= 8
            key |= buf[a - d: b - d]
        low, high = np.searchsorted(end, (a, b - 1), side="right")
        of = np.arange(low, high + 1)
        n = np.minimum(end[of], b) - np.maximum(begin[of], a)
        of, n = of[n > 0], n[n > 0]
        if len(of):
            yield key[real[a:b]], of, n


def _tally(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``n`` by key, in order of the keys."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(n, starts) if len(keys) else n


def count_grams(df: DataFrame, depth: int = DEPTH, text: str = "text", train: str = "train") -> DataFrame:
    """``gram, n, total``: occurrences in the rows whose ``train`` is true, and in all rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learn = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            texts = text_bytes(batch.column(1))
            for flag in (True, False):
                part = [texts[i] for i in np.flatnonzero(learn == flag)]
                for a, b in runs(part, SLICE):
                    for key, _, _ in grams(part[a:b], depth):
                        key, total = np.unique(key, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total * flag), pa.array(total)], names=["gram", "n", "total"])

    found = df.select(F.col(train).alias("train"), F.col(text).alias("text")).mapInArrow(scan, "gram long, n long, total long")
    return found.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


# ---- nodes ---------------------------------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 1/2 (Stirling's series above 8)."""
    x = x.astype(float)
    low = np.ones_like(x)
    for _ in range(8):
        low = np.where(x < 8, low * x, low)
        x = np.where(x < 8, x + 1, x)
    s = 1 / (x * x)
    series = (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s / 1188)))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - np.log(low)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    out = _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)
    return np.where(n0 + n1 > 0, out, 0.0)


class Level:
    """The nodes of one depth in a range of contexts: ``key`` = context * 256 + (1 and the bits so far), sorted."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, n: np.ndarray, deeper: Level | None = None):
        """From the grams of this depth, sorted by (context, byte), and the nodes of the next one."""
        parts = []
        for j in range(8):
            key = (context << 8) | (1 << j) | (byte >> (8 - j))
            starts = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
            ones = n * ((byte >> (7 - j)) & 1)
            parts.append((key[starts], np.add.reduceat(n, starts), np.add.reduceat(ones, starts)))
        key, n_all, n1 = map(np.concatenate, zip(*parts, strict=True))
        order = np.argsort(key, kind="stable")
        self.key, self.n1 = key[order], n1[order]
        self.n0 = n_all[order] - self.n1
        self.log_e = log_kt(self.n0, self.n1)
        self.log_w = self.log_e
        if deeper is not None:
            self.log_w = np.logaddexp(self.log_e, self.sums(deeper.parents(), deeper.log_w)) - LN2

    def parents(self) -> np.ndarray:
        """Key of each node's parent: a context without its earliest byte, the same bits."""
        return ((self.key >> 16) << 8) | (self.key & 255)

    def sums(self, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(self.key, keys), weights=values, minlength=len(self.key))

    def one(self) -> np.ndarray:
        """The estimate that the next bit is 1."""
        return (self.n1 + 0.5) / (self.n0 + self.n1 + 1.0)

    def weight(self) -> np.ndarray:
        """Posterior weight of the node's own estimate against the deeper ones."""
        return np.exp(self.log_e - LN2 - self.log_w)


def levels(key: np.ndarray, n: np.ndarray, depth: int, top: int) -> dict[int, Level]:
    """The levels ``depth`` to ``top`` of whole ranges of grams, sorted."""
    out: dict[int, Level] = {}
    context, byte = key >> 8, key & 255
    for d in range(depth, top - 1, -1):
        out[d] = Level(context, byte, n, out.get(d + 1))
        if d > top:
            both, n = _tally(((context >> 8) << 8) | byte, n)
            context, byte = both >> 8, both & 255
    return out


def _below(depth: int):
    """Grams -> the nodes of depth UPPER + 1, as ``pair, bits, n0, n1, child``."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            level = levels(batch.column(1).to_numpy(), batch.column(2).to_numpy(), depth, UPPER + 1)[UPPER + 1]
            key = level.parents()
            yield pa.RecordBatch.from_arrays(
                [pa.array((key >> 8).astype(np.int32)), pa.array((key & 255).astype(np.int16)), pa.array(level.n0), pa.array(level.n1), pa.array(level.log_w)],
                names=["pair", "bits", "n0", "n1", "child"])

    return fold


def _estimated(sums: DataFrame) -> DataFrame:
    """Summed children -> nodes with ``one`` (estimate of a 1), ``weight`` of it, and ``log_w``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0, n1, child = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("n0", "n1", "child"))
            log_e = log_kt(n0, n1)
            log_w = np.logaddexp(log_e, child) - LN2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((n1 + 0.5) / (n0 + n1 + 1.0)), pa.array(np.exp(log_e - LN2 - log_w)), pa.array(log_w)],
                names=[*batch.schema.names, "one", "weight", "log_w"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sums.schema)
    return sums.mapInArrow(scan, f"{columns}, one double, weight double, log_w double")


def _summed(nodes: DataFrame, *by: Column, child: str) -> DataFrame:
    return _estimated(nodes.groupBy(*by, "bits").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum(child).alias("child")))


def _descend(parents: DataFrame, nodes: DataFrame, on: list[str]) -> DataFrame:
    """``nodes`` with ``sure`` and ``left``: what shallower depths give to the probability of a 1, and what part
    of it is still open; from nodes without training rows on nothing is open."""
    p = parents.select(*on, "sure", "left", F.col("one").alias("p_one"), F.col("weight").alias("p_weight"))
    dead = F.expr("n0 + n1 = 0")
    return nodes.join(p, on).select(
        *nodes.columns,
        (F.col("sure") + F.col("left") * F.col("p_one") * F.when(dead, 1.0).otherwise(F.col("p_weight"))).alias("sure"),
        F.when(dead, 0.0).otherwise(F.col("left") * (1 - F.col("p_weight"))).alias("left"))


def chances(key: np.ndarray, n: np.ndarray, depth: int, upper: dict[str, np.ndarray]) -> np.ndarray:
    """log10 probability of each of the sorted grams; ``upper`` holds the nodes of depth UPPER (key, one, weight, sure, left)."""
    parent_key, one, weight, sure, left = (upper[c] for c in ("key", "one", "weight", "sure", "left"))
    tree = levels(key, n, depth, UPPER + 1)
    for d in range(UPPER + 1, depth + 1):
        level = tree[d]
        at = np.searchsorted(parent_key, level.parents())
        dead = level.n0 + level.n1 == 0
        sure, left = sure[at] + left[at] * one[at] * np.where(dead, 1.0, weight[at]), np.where(dead, 0.0, left[at] * (1 - weight[at]))
        parent_key, one, weight = level.key, level.one(), level.weight()
    p1 = sure + left * one
    out = np.zeros(len(key))
    for j in range(8):
        at = np.searchsorted(parent_key, ((key >> 8) << 8) | (1 << j) | ((key & 255) >> (8 - j)))
        out += np.log10(np.where((key >> (7 - j)) & 1, p1[at], 1 - p1[at]))
    return out


def _valued(depth: int):
    """Sorted rows of depth-UPPER nodes (``part`` 0) and grams -> ``gram, total, value``."""

    names = ("key", "one", "weight", "sure", "left")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: np.zeros(0) for c in names}
        for batch in groups(batches):
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            part = col["place"].to_numpy()
            top = part % 257 == 0
            if top.any():
                rows = batch.filter(pa.array(top))
                new = {c: rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names}
                last = (held["key"] >= (part[0] // 257) << 8) if len(held["key"]) else np.zeros(0, bool)
                held = {c: np.concatenate((held[c][last], new[c])) for c in names}
                held["key"] = held["key"].astype(np.int64)
            if not top.all():
                rows = batch.filter(pa.array(~top))
                key, n, total = (rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("key", "n", "total"))
                value = chances(key, n, depth, held)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total), pa.array(value)], names=["gram", "total", "value"])

    return scan


def values(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram, total, value``: log10 of the probability of a gram's byte after its context, for every row of
    ``counted`` (``gram, n, total``), learnt from ``n``."""
    if not UPPER < depth < 7:
        raise ValueError(f"depth must be between {UPPER + 1} and 6")
    spark = counted.sparkSession
    shift = 8 * (depth + 1 - UPPER)
    pair = F.shiftright("gram", shift).cast("int")
    dealt = counted.select(F.shiftright("gram", shift - 8).alias("place"), "gram", "n", pair.alias("pair"))
    dealt = dealt.repartition("pair").sortWithinPartitions("place", "gram")
    below = dealt.mapInArrow(_below(depth), f"pair int, bits short, {NODE}")
    folder = shared_path(spark, "context-tree")
    _summed(below, F.col("pair"), child="child").write.parquet(folder)
    two = spark.read.parquet(folder).withColumn("first", F.shiftright("pair", 8))
    one = _summed(two, F.col("first"), child="log_w")
    zero = _summed(one, child="log_w").withColumn("sure", F.lit(0.0)).withColumn("left", F.lit(1.0))
    upper = _descend(_descend(zero, one, ["bits"]), two, ["first", "bits"])
    nodes = upper.select(
        "pair", (F.col("pair").cast("long") * 257).alias("place"), (F.col("pair").cast("long") * 256 + F.col("bits")).alias("key"),
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"), "one", "weight", "sure", "left")
    leaf = F.lit(0.0)
    rows = counted.select(
        pair.alias("pair"), (pair.cast("long") * 257 + 1 + F.shiftright("gram", shift - 8).bitwiseAND(255)).alias("place"),
        F.col("gram").alias("key"), "n", "total", leaf.alias("one"), leaf.alias("weight"), leaf.alias("sure"), leaf.alias("left"))
    both = nodes.unionByName(rows).repartition("pair").drop("pair").sortWithinPartitions("place", "key")
    return both.mapInArrow(_valued(depth), "gram long, total long, value double")


# ---- words ---------------------------------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def lower(text: str | Column) -> Column:
    """A-Z lower-cased, nothing else; a null is empty."""
    import string

    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def count_words(df: DataFrame, text: str = "text", train: str = "train") -> DataFrame:
    """``word, n, total``: occurrences in training rows and in all rows, without the ends."""
    words = df.select(F.col(train).alias("train"), F.explode(F.split(F.translate(lower(text), SPACE, " " * len(SPACE)), " ")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count_if("train").alias("n"), F.count(F.lit(1)).alias("total"))


# ---- scoring --------------------------------------------------------------------------------------------------


def _frequent(table: DataFrame, limit: int) -> float:
    """The least total such that at most ``limit`` rows have it or more (by eighths of powers of two)."""
    step = F.floor(F.log2("total") * 8)
    rows = table.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # 8 rows a doubling
    have, least = 0, float("inf")
    for r in rows:
        have += r["count"]
        if have > limit:
            break
        least = 2 ** (r["step"] / 8) * (1 - 1e-9)
    return least


_MODEL: dict = {}  # in a Python worker: the look-up tables of the last model, by its folder


def _held(name: str, table) -> tuple[dict, np.ndarray, pd.Index, np.ndarray]:
    if name not in _MODEL:
        words, counts, keys, logs = table.value
        _MODEL.clear()
        _MODEL[name] = {w: i for i, w in enumerate(words)}, counts, pd.Index(keys), logs
    return _MODEL[name]


def score(df: DataFrame, train: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
          broadcast_grams: int = BROADCAST_GRAMS, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """One row per input row: ``key, trained, n_tokens, n_known, train_tokens, base_score, score`` and ``n_bytes``
    (with the end). The models learn from the rows where ``train`` is true."""
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    folder = shared_path(spark, "lm")
    count_words(rows).write.parquet(f"{folder}/words")
    count_grams(rows, depth).write.parquet(f"{folder}/grams")
    values(spark.read.parquet(f"{folder}/grams"), depth).write.parquet(f"{folder}/values")
    words, valued = spark.read.parquet(f"{folder}/words"), spark.read.parquet(f"{folder}/values")

    learnt = rows.where("train").count()
    got = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    tokens, known = got["n"] + learnt, got["v"] + (learnt > 0)
    least_word, least_gram = _frequent(words, broadcast_words), _frequent(valued, broadcast_grams)
    top_words = words.where(F.col("total") >= least_word).select("word", "n").toArrow()
    top_grams = valued.where(F.col("total") >= least_gram).select("gram", "value").toArrow()
    order = np.argsort(g := top_grams["gram"].to_numpy())
    table = spark.sparkContext.broadcast((  # at most broadcast_words words and broadcast_grams pairs of 8 bytes
        top_words["word"].to_pylist(), top_words["n"].to_numpy(), g[order], top_grams["value"].to_numpy()[order]))
    floor = tokens + 0.1 * (known + 1)
    chance = lambda n: np.log10((n + 0.1) / floor)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counts, keys, logs = _held(folder, table)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for a, b in runs(texts, SLICE // 2):
                yield from _scored(texts[a:b], batch.slice(a, b - a), first, (place, counts, keys, logs), chance, learnt, depth)
                first += b - a

    schema = f"row long, id {df.schema[key].dataType.simpleString()}, train boolean, n_tokens long, n_known long, base double, score double, n_bytes long, word string, gram long, k long"
    rows.mapInArrow(scan, schema).write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    told = scored.where("word IS NULL AND gram IS NULL").drop("word", "gram", "k")
    nothing = [F.lit(None).cast(scored.schema[c].dataType).alias(c) for c in ("id", "train", "n_tokens")]
    rare_word = scored.where("word IS NOT NULL").select("row", "word", "k").join(words.where(F.col("total") < least_word), "word").select(
        "row", *nothing, F.when(F.col("n") > 0, F.col("k")).otherwise(0).alias("n_known"),
        (F.col("k") * F.log10((F.col("n") + 0.1) / F.lit(floor))).alias("base"), F.lit(0.0).alias("score"), F.lit(None).cast("long").alias("n_bytes"))
    rare_gram = scored.where("gram IS NOT NULL").select("row", "gram", "k").join(valued.where(F.col("total") < least_gram), "gram").select(
        "row", *nothing, F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"), (F.col("k") * F.col("value")).alias("score"), F.lit(None).cast("long").alias("n_bytes"))
    total = told.unionByName(rare_word).unionByName(rare_gram).groupBy("row").agg(
        F.max("id").alias("id"), F.max("train").alias("train"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base"), F.sum("score").alias("score"), F.max("n_bytes").alias("n_bytes"))
    return total.select(F.col("id").alias(key), F.col("train").alias("trained"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                        F.col("base").alias("base_score"), "score", "n_bytes")


def _scored(texts, batch, first, model, chance, learnt, depth) -> Iterator[pa.RecordBatch]:
    """The rows of one run of texts, then their words and grams that the broadcast tables lack."""
    place, counts, keys, logs = model
    n = len(texts)
    per = lambda of, weights: np.bincount(of, weights=weights, minlength=n)

    w = Words(texts, BY_SPACE, lower=True)
    each = w.strings().view(pa.large_utf8()).dictionary_encode()
    code, distinct = each.indices.to_numpy(), each.dictionary
    found = np.fromiter((place.get(x, -1) for x in distinct.to_pylist()), np.int64, len(distinct))
    c = np.where(found >= 0, counts[found], 0) if len(counts) else np.zeros(len(found), np.int64)
    value = np.where(found >= 0, chance(c), 0.0)
    base = per(w.doc, value[code]) + chance(learnt)
    n_known = per(w.doc, (c > 0)[code]).astype(np.int64) + (learnt > 0)
    lacking = found[code] < 0
    missing = [(np.stack((w.doc[lacking], code[lacking].astype(np.int64))), True)]

    total = np.zeros(n)
    for gram, of, many in grams(texts, depth):
        at = keys.get_indexer(gram)
        got = np.where(at >= 0, logs[at], 0.0) if len(logs) else np.zeros(len(gram))
        begin = np.cumsum(many) - many
        total[of] += np.add.reduceat(got, begin)
        miss = np.flatnonzero(at < 0)
        missing.append((np.stack((of[np.searchsorted(begin, miss, side="right") - 1], gram[miss])), False))

    def out(rows, ids, train, figures, word, gram, k):
        m = len(rows)
        figures = figures or [pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), ids, train, *figures, word if word is not None else pa.nulls(m, pa.string()),
             gram if gram is not None else pa.nulls(m, pa.int64()), k if k is not None else pa.nulls(m, pa.int64())],
            names=["row", "id", "train", "n_tokens", "n_known", "base", "score", "n_bytes", "word", "gram", "k"])

    size = np.fromiter(map(len, texts), np.int64, n) + 1
    figures = [np.diff(w.first) + 1, n_known, base, total, size]
    yield out(first + np.arange(n), batch.column(0), batch.column(1), [pa.array(x) for x in figures], None, None, None)
    for pairs, is_word in missing:
        if not pairs.shape[1]:
            continue
        order = np.lexsort(pairs[::-1])
        pairs = pairs[:, order]
        starts = np.flatnonzero(np.concatenate(([True], (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))))
        of, what = pairs[:, starts]
        k = pa.array(np.diff(np.append(starts, pairs.shape[1])))
        none = (pa.nulls(len(of), batch.schema.field(0).type), pa.nulls(len(of), pa.bool_()))
        word = distinct.take(pa.array(what)).cast(pa.string()) if is_word else None
        yield out(first + of, *none, None, word, None if is_word else pa.array(what), k)


def held_out(key: str | Column, every: int = 10) -> Column:
    """Whether the crc32 of a key's text is divisible by ``every``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(k.cast("string"), F.lit("")).cast("binary")) % every == 0
