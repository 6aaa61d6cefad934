"""Byte-pair-encoding vocabulary: corpus texts, word counts, learning, encoding, decoding.

Learning runs in rounds over three tables in a shared folder: the *distinct words* ``(sym, freq)``, where ``sym`` is
the word's current symbol sequence as ``array<int>``; the *pair counts* ``(l, r, cnt)``; and the *merge log*.

1. The best pairs by (count desc, left id, right id) are read from the pair table.
2. One scan over the words gathers the neighbourhoods of these pairs: the symbols around every place where one
   stands, up to ``MARGIN`` on each side, counted by content. However many words a corpus has, few neighbourhoods
   differ; a round asks for so many pairs that at most ``max_segments`` of them reach the driver.
3. The driver learns on the neighbourhoods, pair after pair, exactly as on the whole corpus, until the next decision
   depends on something outside them (see ``_Simulation``): hundreds of merges in most rounds.
4. One scan applies the round's merges to the words and emits, for the words that changed, what each pair loses and
   gains; the pair table is the old one plus these signed changes. Words of one symbol leave the table, so
   rounds get cheaper.
5. The log entry (merges, new tokens) is written last and commits the round; only one run can create it. A run that
   finds a log goes on behind its last entry; tables of a round without entry are written anew. Tables of earlier
   rounds are removed.

Rules reproduced (those of the trainer the reference delegates to): ids are the special tokens in
order, then the characters of the corpus by code point, then merged tokens; a merge is the pair
of highest weighted count, ties to the smallest ``(left id, right id)``; learning stops when the
vocabulary is full or the best count is below ``max(1, min_frequency)``.

Encoding splits special tokens out first, pre-tokenizes on the JVM, and maps each pre-token to
ids with a small Arrow UDF (characters to ids, unknown characters to ``<UNK>``, then merges by
lowest rank, leftmost first), caching repeated words per worker.
"""
from __future__ import annotations

import hashlib
import heapq
import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.config import VocabConfig
from corpusprep.functions import text as TX

MAX_SEGMENTS = 100_000  # neighbourhoods that a round sends to the driver
FIRST_PAIRS = 64  # pairs of the first round; doubled while neighbourhoods are few
MOST_PAIRS = 1 << 14
MARGIN = 2  # symbols around a place; more of them decide longer but differ more: with 3, a third more rounds
WORDS_A_TASK = 50_000  # distinct words of a task at the start
MERGES_AT_ONCE = 64  # so many merges of a round are applied to all words of a batch together, more of them word by word
MERGED_BASE = 0x110000  # working ids: characters have their code point, the k-th merged token MERGED_BASE + k, special tokens are negative


# ---- G1-G3 -------------------------------------------------------------------------------------


def corpus_texts(df: DataFrame, src: str = "src", tgt: str = "tgt", key: str | None = None) -> DataFrame:
    """G1: source and target texts interleaved (missing side -> ''): ``[key,] side, text``."""
    missing = [c for c in (src, tgt) if c not in df.columns]
    if missing:
        raise KeyError(f"corpus rows need columns {src!r} and {tgt!r}; missing {missing}")
    keep = [F.col(key)] if key else []
    pairs = F.array(
        F.struct(F.lit(0).alias("side"), F.coalesce(F.col(src), F.lit("")).alias("text")),
        F.struct(F.lit(1).alias("side"), F.coalesce(F.col(tgt), F.lit("")).alias("text")),
    )
    return df.select(*keep, F.inline(pairs))


def word_freq(texts: DataFrame, text: str = "text") -> DataFrame:
    """``word, freq`` over all pre-tokens of the texts."""
    return (
        texts.select(F.explode(TX.pretokens(text)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """``l, r, cnt``: adjacent characters in a table of words and counts (``word, freq``), counted per partition first."""
    from corpusprep.session import ship_package

    ship_package(words.sparkSession)
    counted = _initial_symbols(words).mapInArrow(_step_fn([], True), STEP_SCHEMA).where("kind = 1")
    char = lambda c: F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32").alias(c)
    return counted.groupBy("l", "r").agg(F.sum("cnt").alias("cnt")).select(char("l"), char("r"), "cnt")


# ---- the model ------------------------------------------------------------------------------------


@dataclass
class BpeModel:
    """Vocabulary (id -> token) and merges ``(left_id, right_id, new_id)`` in rank order."""

    tokens: list[str]
    merges: list[tuple[int, int, int]]
    special_tokens: tuple = VocabConfig().special_tokens
    unk_token: str = "<UNK>"
    _index: dict = field(default=None, repr=False)

    @property
    def made(self) -> int:
        """How many tokens were made by merges; they come last."""
        return len({n for _, _, n in self.merges} - set(range(len(self.special_tokens))))

    @property
    def token_to_id(self) -> dict:
        if self._index is None:
            self._index = {t: i for i, t in enumerate(self.tokens)}
        return self._index

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        """``token, id``."""
        return spark.createDataFrame(list(zip(self.tokens, range(len(self.tokens)))), "token string, id int")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        """``rank, left, right, new_id`` (token strings and the merged token's id)."""
        rows = [(i, self.tokens[a], self.tokens[b], n) for i, (a, b, n) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string, new_id int")

    def save(self, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
        """Two Parquet tables ``vocab/`` and ``merges/`` plus the settings in ``meta/``."""
        self.vocab_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/vocab")
        self.merges_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/merges")
        meta = json.dumps({"special_tokens": list(self.special_tokens), "unk_token": self.unk_token})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode(mode).parquet(f"{path}/meta")

    @staticmethod
    def saved(spark: SparkSession, path: str) -> bool:
        """Whether a vocabulary was saved there completely; ``meta/`` is written last."""
        from corpusprep.session import path_exists

        return path_exists(spark, f"{path}/meta/_SUCCESS")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BpeModel":
        v = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
        tokens = [r["token"] for r in v]
        if [r["id"] for r in v] != list(range(len(tokens))):
            raise OSError(f"vocabulary ids at {path} are not contiguous")
        index = {t: i for i, t in enumerate(tokens)}
        m = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        merges = [(index[r["left"]], index[r["right"]], r["new_id"]) for r in m]
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        return cls(tokens, merges, tuple(meta["special_tokens"]), meta["unk_token"])

    def token_id(self, token: str) -> int | None:
        return self.token_to_id.get(token)


# ---- G4: learning ----------------------------------------------------------------------------------


@dataclass
class _State:
    """What a round starts from: the merge log, and with it the version of the word and pair tables."""

    cfg: VocabConfig
    path: str
    version: int
    tokens: list[str]
    merges: list[tuple[int, int, int]]  # working ids
    made: int  # merged tokens so far
    pairs_wanted: int
    done: bool

    def __post_init__(self):
        special = len(self.cfg.special_tokens)
        plain = len(self.tokens) - self.made
        ids = [*range(-special, 0), *(ord(t) for t in self.tokens[special:plain]), *range(MERGED_BASE, MERGED_BASE + self.made)]
        self.text = dict(zip(ids, self.tokens, strict=True))
        self.id_of = {t: i for i, t in self.text.items()}

    def table(self, name: str) -> str:
        return f"{self.path}/{name}-{self.version:06d}"

    def model(self) -> BpeModel:
        vocab = {w: i for i, w in enumerate(self.text)}
        vocab.update((ord(t), i) for i, t in enumerate(self.cfg.special_tokens) if len(t) == 1)
        merges = [(vocab[a], vocab[b], vocab[n]) for a, b, n in self.merges]
        return BpeModel(list(self.tokens), merges, tuple(self.cfg.special_tokens), self.cfg.unk_token)


def _initial_symbols(words: DataFrame, special: dict[int, int] | None = None) -> DataFrame:
    """``sym`` = the word's characters as *working ids*: the code point, but for characters that are special
    tokens themselves (``special``: by code point), which have the id of the token.

    Vocabulary ids give characters ascending code points and merged tokens ascending creation
    order, so working ids (code points, then ``MERGED_BASE + k`` for the k-th created token)
    order every pair exactly as vocabulary ids do - tie-breaks are unchanged - while the table is
    built by one projection, with no join to an alphabet table.
    """
    def working(ch: Column) -> Column:
        out = F.ascii(ch)
        for code, i in (special or {}).items():
            out = F.when(F.ascii(ch) == code, F.lit(i)).otherwise(out)
        return out

    return words.select(F.transform(F.split("word", ""), working).alias("sym"), "freq")


_KEY_SHIFT = 2**31  # keys of pairs: ((l + 2^31) << 32) | (r + 2^31), unsigned; special ids are negative


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left.astype(np.int64) + _KEY_SHIFT).astype(np.uint64) << np.uint64(32)) | (right.astype(np.int64) + _KEY_SHIFT).astype(np.uint64)


class _Words:
    """The words of one Arrow batch: flat symbols, where words begin, frequencies."""

    def __init__(self, sym: pa.Array, freq: pa.Array):
        offsets = np.asarray(sym.offsets, dtype=np.int64)
        self.offsets = offsets - offsets[0]
        self.values = np.asarray(sym.flatten().to_numpy(zero_copy_only=False), dtype=np.int32)
        self.freq = np.asarray(freq.to_numpy(zero_copy_only=False), dtype=np.int64)
        self.word = np.repeat(np.arange(len(self.freq)), np.diff(self.offsets))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(places whose next symbol is of the same word, their pair keys)."""
        at = np.flatnonzero(self.word[1:] == self.word[:-1])
        return at, _pair_keys(self.values[at], self.values[at + 1])


def _isin(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted array."""
    if not len(among):
        return np.zeros(len(keys), bool)
    return among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys


def _counted(keys: np.ndarray, weights: np.ndarray) -> pa.RecordBatch | None:
    distinct, back = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, back, weights)
    distinct, sums = distinct[sums != 0], sums[sums != 0]
    left = (distinct >> np.uint64(32)).astype(np.int64) - _KEY_SHIFT
    right = (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64) - _KEY_SHIFT
    n = len(distinct)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.int64()), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(sums)],
        names=["kind", "sym", "freq", "l", "r", "cnt"])


def apply_merges(sym: list[int], rank: dict[tuple[int, int], list[int]], new: list[int]) -> list[int]:
    """A word after the merges ``0, 1, ...`` of a round, one after the other. ``rank``: the merges of a pair, ascending;
    ``new``: the symbol that a merge makes. A merge only sees pairs that are there when its turn comes."""
    done = 0
    while True:
        first = None
        for pair in zip(sym, sym[1:], strict=False):
            for k in rank.get(pair, ()):
                if k >= done:
                    if first is None or k < first[0]:
                        first = k, pair
                    break
        if first is None:
            return sym
        done, pair = first[0] + 1, first[1]
        sym = _merged(sym, pair, new[first[0]])


def _merged(sym: list[int], pair: tuple[int, int], new: int) -> list[int]:
    out, i = [], 0
    while i < len(sym):
        if i + 1 < len(sym) and (sym[i], sym[i + 1]) == pair:
            out.append(new)
            i += 2
        else:
            out.append(sym[i])
            i += 1
    return out


def _merge_all(values: np.ndarray, word: np.ndarray, merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Many words at once after ``merges``, one after the other: their flat symbols, and the word of each."""
    for l, r, new in merges:
        hit = np.flatnonzero((values[:-1] == l) & (values[1:] == r) & (word[:-1] == word[1:]))
        if l == r and len(hit):  # in a run of one symbol every other place, from the left
            run = np.flatnonzero(np.concatenate(([True], np.diff(hit) != 1)))
            nth = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
            hit = hit[nth % 2 == 0]
        if len(hit):
            values[hit] = new
            values, word = np.delete(values, hit + 1), np.delete(word, hit + 1)
    return values, word


STEP_SCHEMA = "kind tinyint, sym array<int>, freq bigint, l int, r int, cnt bigint"


def _step_fn(merges: list[tuple[int, int, int]], first: bool):
    """One round over a partition of the word table: words with the merges applied (``kind`` 0; without those of one
    symbol) and signed changes of pair counts (``kind`` 1): of the words that changed, or in the first round of all."""
    rank: dict[tuple[int, int], list[int]] = {}
    for k, (l, r, _) in enumerate(merges):
        rank.setdefault((l, r), []).append(k)
    new = [n for _, _, n in merges]
    keys = np.unique(_pair_keys(np.array([p[0] for p in rank], np.int64), np.array([p[1] for p in rank], np.int64))) if rank else np.zeros(0, np.uint64)

    def fn(batches):
        for rb in batches:
            w = _Words(rb.column(0), rb.column(1))
            at, pair = w.links()
            changed = np.unique(w.word[at[_isin(pair, keys)]])
            is_changed = np.zeros(len(w.freq), bool)
            is_changed[changed] = True
            if len(merges) <= MERGES_AT_ONCE:
                inside = is_changed[w.word]
                after, of = _merge_all(w.values[inside], w.word[inside], merges)
            else:
                lists = [apply_merges(w.values[w.offsets[i]: w.offsets[i + 1]].tolist(), rank, new) for i in changed]
                after = np.array([x for s in lists for x in s], np.int32)
                of = np.repeat(changed, np.array([len(s) for s in lists], np.int64))
            touched = is_changed[w.word[at]]
            old_keys, old = (pair, w.freq[w.word[at]]) if first else (pair[touched], -w.freq[w.word[at[touched]]])
            link = np.flatnonzero(of[1:] == of[:-1])
            yield _counted(np.concatenate((old_keys, _pair_keys(after[link], after[link + 1]))), np.concatenate((old, w.freq[of[link]])))
            size = np.diff(w.offsets)
            keep = (size > 1) & ~is_changed
            longer = np.bincount(of, minlength=len(size))
            rest = longer[of] > 1
            sizes = np.concatenate((size[keep], longer[longer > 1]))
            values = np.concatenate((w.values[np.repeat(keep, size)], after[rest]))
            words = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values))
            freq = np.concatenate((w.freq[keep], w.freq[longer > 1]))
            n = len(freq)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int8)), words, pa.array(freq), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                names=["kind", "sym", "freq", "l", "r", "cnt"])

    return fn


def _segments_fn(pairs: np.ndarray, watched: np.ndarray, margin: int):
    """The neighbourhoods of all places where one of ``pairs`` stands, or a symbol of ``watched``: ``segment`` (symbols as
    32-bit integers, then a byte: 1 if the word goes on to the left, 2 if to the right), ``freq``, counted per batch."""

    def fn(batches):
        for rb in batches:
            w = _Words(rb.column(0), rb.column(1))
            at, pair = w.links()
            live = _isin(pair, pairs) | _isin(w.values[at], watched) | _isin(w.values[at + 1], watched)
            inside = np.zeros(len(w.values), bool)
            inside[at[live]] = inside[at[live] + 1] = True
            for _ in range(margin):
                wider = inside.copy()
                wider[at] |= inside[at + 1]
                wider[at + 1] |= inside[at]
                inside = wider
            place = np.flatnonzero(inside)
            if not len(place):
                continue
            breaks = np.flatnonzero((np.diff(place) != 1) | (np.diff(w.word[place]) != 0)) + 1
            begin, end = place[np.concatenate(([0], breaks))], place[np.concatenate((breaks - 1, [len(place) - 1]))] + 1
            of = w.word[begin]
            more = (begin > w.offsets[of]) + 2 * (end < w.offsets[of + 1])
            raw = w.values.astype("<i4").tobytes()
            names = [raw[4 * a: 4 * b] + bytes((m,)) for a, b, m in zip(begin.tolist(), end.tolist(), more.tolist(), strict=True)]
            sums: dict[bytes, int] = {}
            for name, f in zip(names, w.freq[of].tolist(), strict=True):
                sums[name] = sums.get(name, 0) + f
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], names=["segment", "freq"])

    return fn


class _Simulation:
    """Exact learning over neighbourhoods, as long as they decide it.

    Counts of the watched pairs and of every pair with a symbol made here are exact, since all places where they
    stand are in view. Any other pair ranks behind ``last``, the lowest of the pairs asked for, and can only lose. So
    the best pair in view is the best of all until it ranks behind ``last``. Learning also stops before a merge at an
    open end of a neighbourhood (what follows there is not in view), and behind one that makes a token which exists
    already and is not watched (it also stands elsewhere).
    """

    def __init__(self, segments: list[tuple[bytes, int]], pairs: set[tuple[int, int]], watched: set[int], first_new: int):
        self.pairs, self.known, self.first_new = pairs, watched, first_new
        self.sym = [np.frombuffer(s[:-1], "<i4").tolist() for s, _ in segments]
        self.open = [s[-1] for s, _ in segments]
        self.freq = [f for _, f in segments]
        self.count: dict[tuple[int, int], int] = {}
        self.where: dict[tuple[int, int], set[int]] = {}
        for i, s in enumerate(self.sym):
            for p in zip(s, s[1:], strict=False):
                if self.in_view(p):
                    self.count[p] = self.count.get(p, 0) + self.freq[i]
                    self.where.setdefault(p, set()).add(i)
        self.heap = [(-c, *p) for p, c in self.count.items()]
        heapq.heapify(self.heap)

    def in_view(self, p: tuple[int, int]) -> bool:
        l, r = p
        return p in self.pairs or l >= self.first_new or r >= self.first_new or l in self.known or r in self.known

    def best(self) -> tuple[int, int, int] | None:
        """(-count, left, right) of the best pair."""
        while self.heap:
            c, l, r = self.heap[0]
            now = self.count.get((l, r), 0)
            if now == -c:
                return self.heap[0]
            heapq.heappop(self.heap)
            if 0 < now < -c:
                heapq.heappush(self.heap, (-now, l, r))
        return None

    def at_open_end(self, p: tuple[int, int]) -> bool:
        return any((self.open[i] & 1 and (s[0], s[1]) == p) or (self.open[i] & 2 and (s[-2], s[-1]) == p)
                   for i in self.where.get(p, ()) if len(s := self.sym[i]) > 1)

    def merge(self, p: tuple[int, int], new: int) -> None:
        change: dict[tuple[int, int], int] = {}
        for i in self.where.pop(p, ()):
            old, f = self.sym[i], self.freq[i]
            s = self.sym[i] = _merged(old, p, new)
            for q in zip(old, old[1:], strict=False):
                if self.in_view(q):
                    change[q] = change.get(q, 0) - f
            for q in zip(s, s[1:], strict=False):
                if self.in_view(q):
                    change[q] = change.get(q, 0) + f
                    self.where.setdefault(q, set()).add(i)
        for q, d in change.items():
            if d:
                self.count[q] = self.count.get(q, 0) + d
                if d > 0:
                    heapq.heappush(self.heap, (-self.count[q], *q))


def _simulate(state: _State, sim: _Simulation, last: tuple[int, int, int] | None, most: int | None) -> list[tuple[int, int, int]]:
    """Extend the state's merges and tokens as far as ``sim`` decides. Returns the new merges."""
    floor = max(1, state.cfg.min_frequency)
    out: list[tuple[int, int, int]] = []
    while True:
        if len(state.tokens) >= state.cfg.vocab_size:
            state.done = True
            return out
        if most is not None and len(state.merges) >= most:
            return out
        top = sim.best()
        if top is None or (last is not None and top > last):
            state.done = last is None
            return out
        c, l, r = top
        if -c < floor:
            state.done = True
            return out
        if out and sim.at_open_end((l, r)):
            return out
        text = state.text[l] + state.text[r]
        new = state.id_of.get(text)
        unseen = new is not None and new < sim.first_new and new not in sim.known
        if new is None:
            new = MERGED_BASE + state.made
            state.made += 1
            state.tokens.append(text)
            state.text[new], state.id_of[text] = text, new
        sim.merge((l, r), new)
        state.merges.append((l, r, new))
        out.append((l, r, new))
        if unseen:
            return out


def _read_log(spark: SparkSession, path: str) -> list[dict]:
    """The committed entries of a merge log, in order."""
    from corpusprep.session import fs_for

    fs, folder = fs_for(spark, path)
    if not fs.exists(folder):
        return []
    names = sorted(st.getPath().getName() for st in fs.listStatus(folder))
    names = [n for n in names if n.startswith("log-") and n.endswith(".json")]
    return [json.loads(r["value"]) for n in names for r in spark.read.text(f"{path}/{n}", wholetext=True).collect()]


def _resume(spark: SparkSession, path: str, cfg: VocabConfig) -> _State | None:
    log = _read_log(spark, path)
    if not log:
        return None
    settings = json.loads(json.dumps(cfg.__dict__))
    if log[0]["settings"] != settings:
        raise ValueError(f"{path} holds a vocabulary with other settings: {log[0]['settings']}")
    merges = [tuple(m) for entry in log for m in entry["merges"]]
    tokens = [t for entry in log for t in entry["tokens"]]
    return _State(cfg, path, len(log) - 1, tokens, merges, sum(len(e["tokens"]) for e in log[1:]), log[-1]["pairs_wanted"], log[-1]["done"])


def _commit(spark: SparkSession, state: _State, tokens: list[str], merges: list[tuple[int, int, int]]) -> None:
    from corpusprep.session import create_once

    entry = {"settings": state.cfg.__dict__, "tokens": tokens, "merges": merges, "pairs_wanted": state.pairs_wanted, "done": state.done}
    create_once(spark, f"{state.path}/log-{state.version:06d}.json", json.dumps(entry))


def _step(spark: SparkSession, state: _State, merges: list[tuple[int, int, int]], words: DataFrame, pairs: DataFrame | None) -> None:
    """Write the next version of the word and pair tables: the words with ``merges`` applied, and the counts changed by
    what the changed words lose and gain. A version that was begun but not committed is written again."""
    from corpusprep.session import delete_path

    state.version += 1
    step, table = state.table("step"), state.table("pairs")
    for path in (step, table):
        delete_path(spark, path)
    words.mapInArrow(_step_fn(merges, pairs is None), STEP_SCHEMA).write.partitionBy("kind").parquet(step)
    change = spark.read.schema(STEP_SCHEMA).parquet(step).where("kind = 1").select("l", "r", "cnt")
    both = change if pairs is None else pairs.unionByName(change)
    both.groupBy("l", "r").agg(F.sum("cnt").alias("cnt")).where("cnt > 0").write.parquet(table)


def learn_bpe(texts: DataFrame, cfg: VocabConfig = VocabConfig(), text: str = "text", max_merges: int | None = None,
              state_path: str | None = None, max_segments: int = MAX_SEGMENTS, log=None) -> BpeModel:
    """Learn the vocabulary from a frame of texts, to the rules' own end (see the module notes).

    ``state_path``: a shared folder that keeps the merge log; called again with it after a lost driver, learning goes
    on behind the last committed round. Without it a folder of its own is used and removed at the end.
    ``max_merges`` stops early (benchmarks). ``max_segments`` bounds the rows that a round sends to the driver.

    The rounds are many small jobs of a fixed shape over written tables, where adaptive re-planning only adds latency;
    they run in a session of their own with AQE off, so other queries of the caller's session keep their plans.
    """
    from corpusprep.session import delete_path, ensure_checkpoint_dir, shared_path, ship_package

    cfg.validate()
    spark = texts.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    path = state_path or shared_path(spark, "bpe")
    quiet = spark.newSession()
    quiet.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        state = _resume(quiet, path, cfg)
        if state is None:
            delete_path(spark, f"{path}/words")
            word_freq(texts, text).write.parquet(f"{path}/words")
        quiet.conf.set("spark.sql.shuffle.partitions", str(_tasks(quiet, f"{path}/words")))
        if state is None:
            state = _begin(quiet, path, cfg)
        _rounds(quiet, state, max_merges, max_segments, log)
        return state.model()
    finally:
        if state_path is None:
            delete_path(spark, path)


def _tasks(spark: SparkSession, words: str) -> int:
    """Tasks of a round: by the number of distinct words, and not by the session's setting, since a round of many empty tasks
    takes longer than its work."""
    return max(spark.sparkContext.defaultParallelism, -(-spark.read.parquet(words).count() // WORDS_A_TASK))


def _begin(spark: SparkSession, path: str, cfg: VocabConfig) -> _State:
    """Version 0: the alphabet, the words as characters, all pair counts."""
    singles = {ord(t): i - len(cfg.special_tokens) for i, t in enumerate(cfg.special_tokens) if len(t) == 1}
    words = spark.read.parquet(f"{path}/words").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    initial = _initial_symbols(words, singles)
    codes = sorted(r["c"] for r in initial.select(F.explode("sym").alias("c")).distinct().collect() if r["c"] >= 0)
    tokens = [*cfg.special_tokens, *(chr(c) for c in codes)]
    state = _State(cfg, path, -1, tokens, [], 0, FIRST_PAIRS, False)
    _step(spark, state, [], initial, None)
    _commit(spark, state, tokens, [])
    return state


def _next_wanted(wanted: int, segments: int, most: int) -> int:
    """Pairs to ask for next: as many as would give three quarters of ``most`` neighbourhoods, at most four times as many."""
    return max(wanted, min(4 * wanted, wanted * most * 3 // (4 * max(segments, 1))))


def _rounds(spark: SparkSession, state: _State, max_merges: int | None, max_segments: int, log) -> None:
    from corpusprep.session import delete_path

    rounds = 0
    while not state.done and (max_merges is None or len(state.merges) < max_merges):
        words = spark.read.schema(STEP_SCHEMA).parquet(state.table("step")).where("kind = 0").select("sym", "freq")
        pairs = spark.read.parquet(state.table("pairs"))
        wanted, margin = state.pairs_wanted, MARGIN
        while True:
            top = [(-r["cnt"], r["l"], r["r"]) for r in pairs.orderBy(F.col("cnt").desc(), "l", "r").limit(wanted).collect()]
            chosen = {(l, r) for _, l, r in top}
            watched = {i for l, r in chosen if (i := state.id_of.get(state.text[l] + state.text[r])) is not None}
            keys = np.unique(_pair_keys(np.array([l for l, _ in chosen], np.int64), np.array([r for _, r in chosen], np.int64)))
            found = words.mapInArrow(_segments_fn(keys, np.array(sorted(watched), np.int32), margin), "segment binary, freq bigint")
            near = found.groupBy("segment").agg(F.sum("freq").alias("freq")).limit(max_segments + 1).toArrow() if top else None
            if near is None or near.num_rows <= max_segments:
                break
            if wanted > 1:
                wanted = max(1, wanted // 4)
            elif margin > 1:
                margin = 1
            else:  # one pair between two symbols: at most one segment per two symbols and run
                near = found.groupBy("segment").agg(F.sum("freq").alias("freq")).toArrow()
                break
        first_new, made, old = MERGED_BASE + state.made, state.made, len(state.merges)
        if near is None:
            state.done = True
        else:
            sim = _Simulation(list(zip(near["segment"].to_pylist(), near["freq"].to_pylist(), strict=True)), chosen, watched, first_new)
            _simulate(state, sim, top[-1] if len(top) == wanted else None, max_merges)
            wanted = _next_wanted(wanted, near.num_rows, max_segments)
        state.pairs_wanted = min(wanted, MOST_PAIRS)
        merges = state.merges[old:]
        before = state.version
        if merges and not state.done:
            _step(spark, state, merges, words, pairs)
        else:
            state.version += 1
        _commit(spark, state, [state.text[MERGED_BASE + k] for k in range(made, state.made)], merges)
        for name in ("step", "pairs"):
            delete_path(spark, f"{state.path}/{name}-{before:06d}")
        rounds += 1
        if log:
            log(rounds, len(state.merges), len(state.tokens), {"top": -top[0][0] if top else 0, "pairs": len(top), "segments": near.num_rows if near is not None else 0, "merged": len(merges)})


# ---- G6 / G7: encode and decode -------------------------------------------------------------------------

_CACHE: dict = {}  # in a Python worker: the encoder of the last model, by the hash of its content
WORDS_KEPT = 1_000_000  # encoded words a worker keeps; beyond it they are encoded again, with the same result


def _merge_word(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merges in order of their rank, leftmost first, by a heap of the pairs of a linked list."""
    if len(ids) < 2:
        return ids
    right, left, alive = list(range(1, len(ids))) + [-1], list(range(-1, len(ids) - 1)), [True] * len(ids)
    heap = [(*ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
    heapq.heapify(heap)
    while heap:
        _, new, i, pair = heapq.heappop(heap)
        j = right[i] if alive[i] else -1
        if j < 0 or (ids[i], ids[j]) != pair:
            continue  # one of the two has been merged since
        ids[i], alive[j], right[i] = new, False, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for k in (left[i], i):
            if k >= 0 and right[k] >= 0 and (p := (ids[k], ids[right[k]])) in ranks:
                heapq.heappush(heap, (*ranks[p], k, p))
    return [x for x, a in zip(ids, alive, strict=True) if a]


def _word_encoder(model_key: str, tokens: list[str], merges: list[tuple[int, int, int]], specials: tuple, unk: str):
    """word -> ids, with a bounded memory of words."""
    if model_key in _CACHE:
        return _CACHE[model_key]
    index = {t: i for i, t in enumerate(tokens)}
    ranks = {(a, b): (rank, n) for rank, (a, b, n) in enumerate(merges)}
    special_ids = {s: index[s] for s in specials if s in index}
    unk_id = index.get(unk)
    known: dict[str, list[int]] = {}

    def encode_word(w: str) -> list[int]:
        out = known.get(w)
        if out is None:
            if w in special_ids:
                out = [special_ids[w]]
            else:
                out = _merge_word([i for ch in w if (i := index.get(ch, unk_id)) is not None], ranks)
            if len(known) < WORDS_KEPT:
                known[w] = out
        return out

    _CACHE.clear()
    _CACHE[model_key] = encode_word
    return encode_word


def encode(df: DataFrame, model: BpeModel, text: str, out: str = "ids") -> DataFrame:
    """Text -> ``array<int>`` ids. Specials are cut out first; pre-tokens are built on the JVM; of each
    Arrow batch the distinct words are encoded once, and the ids of all words gathered from them."""
    spark = df.sparkSession
    from corpusprep.session import ship_package

    ship_package(spark)
    content = (model.tokens, model.merges, tuple(model.special_tokens), model.unk_token)
    bc = spark.sparkContext.broadcast(content)  # bounded by the vocabulary size
    key = hashlib.sha1(repr(content).encode("utf-8", "surrogatepass")).hexdigest()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _ids(pieces: pd.Series) -> pd.Series:
        enc = _word_encoder(key, *bc.value)
        n = np.array([0 if p is None else len(p) for p in pieces], np.int64)
        words = np.concatenate([np.asarray(p, object) for p in pieces if p is not None and len(p)]) if n.any() else np.zeros(0, object)
        codes, distinct = pd.factorize(words)
        table = [enc(w) for w in distinct]
        sizes = np.array([len(x) for x in table], np.int64)
        flat = np.array([i for x in table for i in x], np.int32)
        begin = np.cumsum(sizes) - sizes
        per_word = sizes[codes]
        place = np.arange(per_word.sum()) - np.repeat(np.cumsum(per_word) - per_word, per_word)
        ids = flat[np.repeat(begin[codes], per_word) + place]
        ends = np.concatenate(([0], np.cumsum(per_word)))[np.concatenate(([0], np.cumsum(n)))]
        return pd.Series([ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])

    return df.withColumn(out, _ids(TX.pretokens_with_specials(text, model.special_tokens)))


def decode(df: DataFrame, model: BpeModel, ids: str | list[str], out: str | list[str] = "decoded") -> DataFrame:
    """Ids -> text: the tokens of the ids, without special tokens and unknown ids, joined by a space; null
    ids give an empty text. Several columns may be decoded at once. No shuffle, and no Python per token: the tokens
    are gathered from the vocabulary by an Arrow ``take`` over the ids of a whole batch."""
    names, outs = ([ids], [out]) if isinstance(ids, str) else (ids, out)
    special = set(model.special_tokens)
    bc = df.sparkSession.sparkContext.broadcast((model.tokens, [t not in special for t in model.tokens]))  # bounded by the vocabulary size

    @F.arrow_udf(T.StringType())
    def text(rows: pa.Array) -> pa.Array:
        tokens, plain = bc.value
        rows = rows.fill_null([]) if rows.null_count else rows
        flat = rows.flatten()
        known = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens))), False)
        index = pc.if_else(known, flat, 0).cast(pa.int64())
        keep = pc.and_(known, pa.array(plain, pa.bool_()).take(index)).to_numpy(zero_copy_only=False) if len(tokens) else np.zeros(len(flat), bool)
        offsets = np.asarray(rows.offsets, np.int64)
        ends = np.concatenate(([0], np.cumsum(keep)))[offsets - offsets[0]]
        found = pa.array(tokens, pa.string()).take(index.filter(pa.array(keep)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), found), " ")

    return df.withColumns({o: text(F.col(c)) for c, o in zip(names, outs, strict=True)})
