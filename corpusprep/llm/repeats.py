"""Repeated passages through a sparse suffix array.

Goal: every passage of at least ``min_words`` words (runs of non-space characters) that occurs twice in
the corpus, with exact borders.

1. *Sparse suffixes.* Of all suffixes of a text only those at minimiser positions are kept: of every
   ``sample`` neighbouring places, the one whose next few words hash lowest. Content alone selects
   them, so two copies of a passage keep the same suffixes. A window of ``min_words`` words holds at least
   two, one chosen from its first ``sample`` places and one from the next, and both are followed by at
   least ``prefix`` words of the window.
2. *Sort and compare.* The suffixes are brought together by a hash of those first words. Suffixes with an
   equal neighbour are candidates; on ordinary text few are.
3. *Extend.* Where both suffixes of a window are candidates, the window is hashed and compared with those
   of its partners: left and right as far as the minimisers reach. Windows that occur again and follow
   each other with the same owner join into maximal matches.

Equal texts are one text up to the end and count as copies of each other as a whole. Each comparison is
a grouped aggregation, pre-aggregated before its shuffle, and an equi-join that adaptive execution can
split, so a passage held by a third of all documents is spread over many tasks and its occurrences are
never listed pairwise. Of equal texts the smallest key is the owner; of the different texts with a
passage the one with the smallest hash. All other occurrences are copies.

Defined cases: a null text has no words; texts below ``min_words`` words have no passage; rows that share
key and text are one document; a passage that repeats inside one text, without overlap, is a copy of its
first place; null keys are a key of their own, never an owner of others; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.textbuf import BY_SPACE, U64, Words, covered, duplicated, mix, prefix_hash, runs, span_hash, squeezed, text_bytes, unsqueezed
from corpusprep.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Passages:
    """``min_words``: shortest passage; ``sample``: places of which one suffix is kept; ``order_words``: words that rank a place."""

    min_words: int = 50
    sample: int = 18
    order_words: int = 6

    @property
    def prefix(self) -> int:
        return self.min_words - 2 * self.sample + 1

    def __post_init__(self):
        if not 1 <= self.order_words <= self.prefix:
            raise ValueError("order_words must lie between 1 and min_words - 2 * sample + 1")


class Sampled:
    """Windows of a run of texts (``start``: first word) and the two minimisers (``anchors``) of each."""

    def __init__(self, texts: list[bytes], p: Passages):
        self.words = w = Words(texts, BY_SPACE)
        self.prefix = prefix_hash(w.hashes())
        n = len(w.doc)
        places = n - p.order_words + 1
        self.start = self.suffix = np.zeros(0, np.int64)
        self.anchors = (self.start, self.start)
        if n < p.min_words:
            return
        at = np.arange(places)
        bits = U64(max(20, n.bit_length()))
        low = ((span_hash(self.prefix, at, at + p.order_words) >> bits) << bits) | at.astype(U64)
        width = 1
        while 2 * width <= p.sample:  # sliding minimum by doubling
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < p.sample:
            low = np.minimum(low[: len(low) - (p.sample - width)], low[p.sample - width:])
        start = np.arange(n - p.min_words + 1)
        start = start[start + p.min_words <= w.first[1:][w.doc[start]]]
        places = (low & ((U64(1) << bits) - U64(1))).astype(np.int64)
        self.start, self.anchors = start, (places[start], places[start + p.sample])
        self.suffix = np.union1d(*self.anchors)

    def hashes(self, starts: np.ndarray, n: int) -> np.ndarray:
        return span_hash(self.prefix, starts, starts + n)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(flat: np.ndarray, doc: np.ndarray, n: int) -> pa.Array:
    """Values in the order of their rows as one list per row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), _signed(flat))


def _suffixes(p: Passages):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(2))
                for a, b in runs(texts):
                    s = Sampled(texts[a:b], p)
                    doc, key = s.words.doc[s.suffix], s.hashes(s.suffix, p.prefix)
                    salted = key ^ mix(doc.astype(U64) + U64(1))
                    twice = duplicated(salted)
                    once = np.sort(np.unique(salted, return_index=True)[1])
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(a, b - a).columns[:2], pa.array(np.diff(s.words.first)),
                         _lists(key[once], doc[once], b - a), _lists(key[twice], doc[twice], b - a)],
                        names=["doc", "row", "words", "suffixes", "twice"])

    return scan


def _windows(p: Passages):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        with np.errstate(over="ignore"):
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                fresh = np.append(last is None or ids[0] != last, ids[1:] != ids[:-1]) if len(ids) else np.zeros(0, bool)
                last = ids[-1] if len(ids) else last
                batch = batch.filter(pa.array(fresh))  # of equal texts, which the join leaves side by side, one is enough
                ids, texts, lists = ids[fresh], unsqueezed(batch.column(1)), batch.column(2)
                for a, b in runs(texts):
                    s, part = Sampled(texts[a:b], p), lists.slice(a, b - a)
                    salt = mix(np.arange(b - a, dtype=U64) + U64(1))
                    wanted = part.flatten().to_numpy(zero_copy_only=False).view(U64) ^ np.repeat(salt, np.asarray(part.value_lengths()))
                    known = np.isin(s.hashes(s.suffix, p.prefix) ^ salt[s.words.doc[s.suffix]], wanted)
                    start = s.start
                    for anchor in s.anchors if len(start) else ():
                        start = np.intersect1d(start, s.start[known[np.searchsorted(s.suffix, anchor)]], assume_unique=True)
                    doc, key = s.words.doc[start], s.hashes(start, p.min_words)
                    _, first, back, n = np.unique(key ^ salt[doc], return_index=True, return_inverse=True, return_counts=True)
                    at = start - s.words.first[doc]
                    later = np.ones(len(at), bool)
                    later[first] = False
                    order = np.flatnonzero(later)[np.argsort(back[later], kind="stable")]  # by passage, then by place
                    ends = np.cumsum(n - 1)
                    more = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(at[order].astype(np.int32)))
                    last_place = at[first].copy()
                    last_place[n > 1] = at[order[ends[n > 1] - 1]]
                    yield pa.RecordBatch.from_arrays(
                        [_signed(key[first]), pa.array(ids[a:b][doc[first]]), pa.array(at[first].astype(np.int32)),
                         pa.array(last_place - at[first] >= p.min_words), pc.if_else(pa.array(n > 1), more, pa.scalar(None, more.type))],
                        names=["passage", "row", "start", "apart", "more"])

    return scan


def _text_spans(df: DataFrame, key: str, text: str, p: Passages) -> tuple[DataFrame, DataFrame]:
    """(rows ``doc, row, words``; spans of different texts ``row, owner, copy, word_start, n_words``); ``row`` stands for a text."""
    ensure_checkpoint_dir(df.sparkSession)
    plain = df.select(F.col(key).alias("doc"), F.xxhash64(df[text]).alias("row"), F.col(text).alias("text"))
    kind = df.schema[key].dataType.simpleString()
    sampled = plain.mapInArrow(_suffixes(p), f"doc {kind}, row long, words long, suffixes array<long>, twice array<long>").checkpoint()
    suffixes = sampled.select("row", F.explode("suffixes").alias("suffix"))
    again = (suffixes.groupBy("suffix").agg(F.min("row").alias("r0"), F.max("row").alias("r1")).where("r0 <> r1").select("suffix")
             .union(sampled.select(F.explode("twice").alias("suffix"))).distinct())
    wanted = suffixes.join(again, "suffix", "left_semi").groupBy("row").agg(F.collect_set("suffix").alias("suffixes"))
    windows = squeezed(plain.select("row", "text"), "text").join(wanted, "row").select("row", "text", "suffixes").mapInArrow(
        _windows(p), "passage long, row long, start int, apart boolean, more array<int>")  # one row for a text and passage
    owners = (windows.groupBy("passage").agg(F.min("row").alias("owner"), F.max("row").alias("last"), F.max("apart").alias("apart"))
              .where("owner <> last OR apart").select("passage", "owner"))
    places = F.concat(F.array(F.col("first")), F.coalesce("more", F.array().cast("array<int>")))
    found = (windows.withColumnRenamed("start", "first").join(owners, "passage").select("row", "owner", "first", F.explode(places).alias("start"))
             .select("row", "owner", "start", ((F.col("row") != F.col("owner")) | (F.col("start") - F.col("first") >= p.min_words)).alias("copy")))
    by = ["row", "owner", "copy"]
    island = F.col("start") - F.dense_rank().over(Window.partitionBy(*by).orderBy("start"))
    spans_ = found.withColumn("island", island).groupBy(*by, "island").agg(
        F.min("start").alias("word_start"), (F.max("start") - F.min("start") + p.min_words).alias("n_words")).drop("island")
    return sampled.select("doc", "row", "words"), spans_


def spans(df: DataFrame, key: str = "doc_id", text: str = "text", passages: Passages | None = None) -> DataFrame:
    """One row per maximal match of a text with a passage's owner (the owner's own place included):
    ``key, first_<key>, word_start, n_words, copy``."""
    p = passages or Passages()
    rows, found = _text_spans(df, key, text, p)
    texts = rows.groupBy("row").agg(F.min("doc").alias("head"), F.count(F.lit(1)).alias("n"), F.max("words").alias("words"))
    names = [key, f"first_{key}", "word_start", "n_words", "copy"]
    heads = texts.select("row", "head")
    parts = found.join(heads, "row").join(heads.select(F.col("row").alias("owner"), F.col("head").alias("of")), "owner").select(
        "head", "of", "word_start", "n_words", "copy")
    whole = texts.where((F.col("n") > 1) & (F.col("words") >= p.min_words)).select("row", "head")
    equal = rows.join(whole, "row").distinct().select(
        "doc", "head", F.lit(0).cast("long").alias("word_start"), "words", (~F.col("doc").eqNullSafe(F.col("head"))).alias("copy"))
    return parts.toDF(*names).union(equal.toDF(*names))


def remove(df: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars", passages: Passages | None = None) -> DataFrame:
    """``df``, all its columns, without the copies: their words go, the owner's place stays.

    A row that loses all its words goes. ``length``, if such a column exists, is set to the new length.
    """
    p = passages or Passages()
    names = df.columns
    rows, found = _text_spans(df, key, text, p)
    texts = rows.groupBy("row").agg(F.min("doc").alias("head"), F.count(F.lit(1)).alias("n"), F.max("words").alias("words"))
    whole = texts.where((F.col("n") > 1) & (F.col("words") >= p.min_words)).select("row", "head", F.lit(True).alias("equal"))
    cuts = found.where("copy").groupBy("row").agg(F.collect_list(F.struct("word_start", "n_words")).alias("cuts"))
    marks = cuts.join(whole, "row", "full").select(F.col("row").alias("mark"), "cuts", "head", "equal")
    plain = df.withColumn("__row", F.xxhash64(df[text])).toDF(*(f"c{i}" for i in range(len(names))), "own")
    gone = F.coalesce("equal", F.lit(False)) & ~F.col(f"c{names.index(key)}").eqNullSafe(F.col("head"))
    joined = plain.join(marks, plain["own"] == marks["mark"], "left").where(~gone).select(*plain.columns[:-1], "cuts")
    place = names.index(text)
    size = names.index(length) if length in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names)).to_pylist()
            columns = list(batch.columns[: len(names)])
            if any(lists):
                texts, stays = columns[place].to_pylist(), np.ones(len(lists), bool)
                sizes = columns[size].to_pylist() if size is not None else []
                for i, found in enumerate(lists):
                    if found:
                        texts[i] = without(texts[i], [(c["word_start"], c["n_words"]) for c in found])
                        stays[i] = bool(texts[i])
                        if size is not None:
                            sizes[i] = len(texts[i])
                columns[place] = pa.array(texts, columns[place].type)
                if size is not None:
                    columns[size] = pa.array(sizes, columns[size].type)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[: len(names)]).filter(pa.array(stays))
            else:
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[: len(names)])

    return joined.mapInArrow(cut, plain.drop("own").schema).toDF(*names)


def without(text: str, cuts: list[tuple[int, int]]) -> str:
    """The text without some ranges (first word, number) of its words; '' if no word is left."""
    raw = text.encode()
    w = Words([raw], BY_SPACE)
    gone = np.zeros(len(w.doc), bool)
    for n in {n for _, n in cuts}:
        gone |= covered(np.array([s for s, m in cuts if m == n]), n, len(gone))
    if gone.all():
        return ""
    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    begin = np.append(w.starts, len(raw))
    out, at = [], 0
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        out.append(raw[at: begin[a]])
        at = begin[b]
    out.append(raw[at:])
    return b"".join(out).decode().rstrip(" \t\n\r\v\f")
