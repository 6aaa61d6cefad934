"""License scan by patience alignment.

A text and a template are aligned on the words that occur exactly once in either: of these anchors, in the
order of the text, the longest increasing subsequence of template places is kept, and the gaps between
neighbouring anchors are aligned in the same way, with the words that are unique inside them. Gaps without
anchor count the words they share at their two ends. The share of a template's words that are aligned is its coverage.

A text is only aligned where a template can be: the words of all templates are coded once, texts are coded
in NumPy by word hash, and a *site* is a stretch that holds a large enough share of one template's rare words
(those in few templates), with room on both sides for the rest of the template. A site is split where its rare
words agree on several places at which the template begins, and what lies between its occurrences is searched
again, so that a repeated template is found each time. A template covers a text if an occurrence reaches the
coverage of its kind; of templates that overlap those with the most aligned words together stay.

One pass over the scan, no shuffle; texts are never cut.

Defined cases: a null or empty text has no license; repeated rows get a row each; extra columns are ignored.
"""
from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.license_texts import TEMPLATES
from corpusprep.llm.textbuf import ALNUM, Words, runs, text_bytes

#: Words of a template that stand for any one word.
ANY = 0
#: What a foreign word between two aligned ones takes off, in aligned words.
STRAY = 0.2


@dataclass(frozen=True)
class Limits:
    """Least coverage by kind of template, and the least share of its rare words that makes a site."""

    coverage: dict[str, float] = field(default_factory=lambda: {"line": 0.85, "body": 0.7})
    rare_share: float = 0.5
    rare_templates: int = 6


def increasing(places: Sequence[int]) -> list[int]:
    """Indices of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        if k == len(tops):
            tops.append(p)
            ends.append(i)
        else:
            tops[k], ends[k] = p, i
        back.append(ends[k - 1] if k else -1)
    out: list[int] = []
    i = ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned places (in ``a``, in ``b``), increasing in both; ``ANY`` in ``b`` agrees with every word next to an aligned one.

    The ends of ``a`` are no aligned words: there, edges are only compared where nothing is unique."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), False, False)]
    while todo:
        a0, a1, b0, b1, left, right = todo.pop()
        edges = free = not left and not right
        chain = _chain(a, b, a0, a1, b0, b1) if free else []
        if not chain:
            while (left or edges) and a0 < a1 and b0 < b1 and (a[a0] == b[b0] or left and b[b0] == ANY):
                out.append((a0, b0))
                a0, b0, left = a0 + 1, b0 + 1, True
            while (right or edges) and a0 < a1 and b0 < b1 and (a[a1 - 1] == b[b1 - 1] or right and b[b1 - 1] == ANY):
                a1, b1, right = a1 - 1, b1 - 1, True
                out.append((a1, b1))
            chain = _chain(a, b, a0, a1, b0, b1)
        if not chain:
            continue
        out.extend(chain)
        ends = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        todo += [(i0 + 1, i1, j0 + 1, j1, n > 0 or left, n < len(chain) or right)
                 for n, ((i0, j0), (i1, j1)) in enumerate(zip(ends, ends[1:])) if i0 + 1 < i1 and j0 + 1 < j1]
    return sorted(out)


def _chain(a: Sequence[int], b: Sequence[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Increasing anchors of a gap: words that are unique on both sides."""
    left, right = Counter(a[a0:a1]), Counter(b[b0:b1])
    where = {w: j for j, w in enumerate(b[b0:b1], b0) if right[w] == 1 and left.get(w) == 1 and w != ANY}
    anchors = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in where]
    return [anchors[k] for k in increasing([j for _, j in anchors])]


def compact(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The neighbouring pairs with the most words after ``STRAY`` is taken off for every foreign word between them."""
    best, begin, total, low = (0.0, 0, 0), 0, 0.0, 0
    for n, (i, j) in enumerate(pairs):
        if n:
            total -= STRAY * max(0, i - pairs[n - 1][0] - (j - pairs[n - 1][1]))
        if total <= 0:
            begin, total = n, 0.0
        total += 1
        if total > best[0]:
            best = (total, begin, n + 1)
    return pairs[best[1]: best[2]]


def heaviest(found: list[tuple[str, str, float, int, int, int]]) -> list[tuple[str, str, float, int, int, int]]:
    """Matches that do not overlap, by place, with the most aligned words together (then the most coverage)."""
    found = sorted(found, key=lambda f: (f[3] + f[4], -f[5], -f[2], f[0], f[3]))
    ends = [f[3] + f[4] for f in found]
    best, taken = [(0, 0.0)], []
    for n, f in enumerate(found):
        before = bisect_right(ends, f[3], 0, n)
        whole = (best[before][0] + f[5], best[before][1] + f[2])
        taken.append(before if whole > best[n] else -1)
        best.append(max(whole, best[n]))
    kept, n = [], len(found)
    while n:
        if taken[n - 1] < 0:
            n -= 1
        else:
            kept.append(found[n - 1])
            n = taken[n - 1]
    return kept[::-1]


class Library:
    """Templates as word codes (from 1 on; ``ANY`` is 0)."""

    def __init__(self, templates=TEMPLATES, limits: Limits | None = None):
        self.limits = limits or Limits()
        self.names = [(t[0], t[1]) for t in templates]
        with np.errstate(over="ignore"):
            w = Words([t[2].replace("*", " \ue000 ").encode() for t in templates], ALNUM, b" ", lower=True)
            hashes, any_ = w.hashes(), Words(["\ue000".encode()], ALNUM, b" ").hashes()[0]
        self.vocabulary, codes = np.unique(hashes, return_inverse=True)
        codes = codes + 1
        codes[hashes == any_] = ANY
        self.codes = [codes[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        df = Counter(c for t in self.codes for c in set(t) if c != ANY)
        self.rare = [{c for c in t if c != ANY and df[c] <= self.limits.rare_templates} or {c for c in t if c != ANY} for t in self.codes]
        owners: dict[int, list[int]] = {}
        for k, rare in enumerate(self.rare):
            for c in rare:
                owners.setdefault(c, []).append(k)
        self.owners = owners
        self.at: list[dict[int, list[int]]] = [{} for _ in self.codes]
        for k, t in enumerate(self.codes):
            for j, c in enumerate(t):
                if c in self.rare[k]:
                    self.at[k].setdefault(c, []).append(j)
        self.is_rare = np.zeros(len(self.vocabulary) + 1, bool)
        self.is_rare[list(owners)] = True

    def code(self, hashes: np.ndarray) -> np.ndarray:
        """-1 for words of no template."""
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[place] == hashes, place + 1, -1) if len(hashes) else place

    def _need(self, k: int) -> int:
        return max(1, int(np.ceil(self.limits.rare_share * len(self.rare[k]))))

    def sites(self, k: int, found: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """(from, to) in ``found``, the rare words (place, code) of a template: stretches with enough different ones."""
        need, width = self._need(k), 2 * len(self.codes[k])
        seen: Counter = Counter()
        low, site = 0, None
        for n, (p, c) in enumerate(found):
            seen[c] += 1
            while found[low][0] <= p - width:
                seen[found[low][1]] -= 1
                if not seen[found[low][1]]:
                    del seen[found[low][1]]
                low += 1
            if len(seen) >= need:
                if site and low < site[1]:
                    site = (site[0], n + 1)
                else:
                    if site:
                        yield site
                    site = (low, n + 1)
        if site:
            yield site

    def starts(self, k: int, found: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """(lowest, highest) place where an occurrence of the template may begin: rare words that agree on it, the most first."""
        votes = sorted((p - j, c) for p, c in found for j in self.at[k][c])
        size, need = len(self.codes[k]), (self._need(k) + 1) // 2
        seen: Counter = Counter()
        low, windows = 0, []
        for d, c in votes:
            seen[c] += 1
            while votes[low][0] < d - size // 8 - 1:
                seen[votes[low][1]] -= 1
                if not seen[votes[low][1]]:
                    del seen[votes[low][1]]
                low += 1
            if len(seen) >= need:
                windows.append((-len(seen), d - votes[low][0], votes[low][0], d))
        chosen: list[tuple[int, int]] = []
        for _, _, low, high in sorted(windows):
            n = bisect_left(chosen, (low, high))
            if all(abs(low - other) > size // 2 for other, _ in chosen[max(0, n - 1): n + 1]):
                insort(chosen, (low, high))
        return chosen

    def matched(self, k: int, codes: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
        """Aligned places of the template in a region, if they reach the coverage."""
        template = self.codes[k]
        pairs = [(lo + i, j) for i, j in align(codes[lo:hi].tolist(), template)]
        for tried in (compact(pairs), pairs):
            if len(tried) / len(template) >= self.limits.coverage[self.names[k][1]] and any(template[j] != ANY for _, j in tried):
                return tried
        return []

    def occurrences(self, k: int, codes: np.ndarray, found: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
        """Aligned places of every occurrence of the template in a site.

        One region for each place where an occurrence may begin, up to its neighbours; what lies between the
        occurrences is a site of its own until nothing more reaches the coverage.
        """
        size = len(self.codes[k])
        lo, hi = max(0, found[0][0] - size), min(len(codes), found[-1][0] + 1 + size)
        begins, slack, done, spans = self.starts(k, found), size // 8 + 2, lo, []
        for n, (low, high) in enumerate(begins):
            a = max(done, min(begins[n - 1][1] + size, low) - slack) if n else lo
            b = min(hi, max(begins[n + 1][0], high + size) + slack) if n + 1 < len(begins) else hi
            if pairs := self.matched(k, codes, a, b) if a < b else []:
                yield pairs
                done = pairs[-1][0] + 1
                spans.append((pairs[0][0], done))
        todo = [(a, b) for (_, a), (b, _) in zip([(lo, lo), *spans], [*spans, (hi, hi)])] if len(begins) != 1 or spans else [(lo, hi)]
        while todo:
            lo, hi = todo.pop()
            inside = found[bisect_left(found, (lo, -1)): bisect_left(found, (hi, -1))]
            for m, n in self.sites(k, inside):
                a, b = max(lo, inside[m][0] - size), min(hi, inside[n - 1][0] + 1 + size)
                if pairs := self.matched(k, codes, a, b):
                    yield pairs
                    todo += [(a, pairs[0][0]), (pairs[-1][0] + 1, b)]

    def scan(self, codes: np.ndarray) -> list[tuple[str, str, float, int, int, int]]:
        """(license, kind, coverage, first word, words spanned, aligned words) of what stands in one text."""
        at = np.flatnonzero(self.is_rare[np.maximum(codes, 0)] & (codes > 0))
        places: dict[int, list[tuple[int, int]]] = {}
        for p, c in zip(at.tolist(), codes[at].tolist(), strict=True):
            for k in self.owners.get(c, ()):
                places.setdefault(k, []).append((p, c))
        found = []
        for k, rare in places.items():
            for m, n in self.sites(k, rare):
                for pairs in self.occurrences(k, codes, rare[m:n]):
                    found.append((*self.names[k], round(len(pairs) / len(self.codes[k]), 6), pairs[0][0], pairs[-1][0] - pairs[0][0] + 1, len(pairs)))
        return heaviest(found)


NAMES = ("license", "kind", "coverage", "word_start", "n_words", "n_aligned")
MATCH = "struct<license:string,kind:string,coverage:double,word_start:long,n_words:long,n_aligned:long>"


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, limits: Limits | None = None) -> DataFrame:
    """One row per input row: ``key, n_words, licenses`` (sorted names), ``matches``, ``coverage`` (best, 0.0 without a match)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Library(templates, limits)
        kind = pa.list_(pa.struct([("license", pa.string()), ("kind", pa.string()), ("coverage", pa.float64()), ("word_start", pa.int64()),
                                   ("n_words", pa.int64()), ("n_aligned", pa.int64())]))
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(1))
                for a, b in runs(texts):
                    w = Words(texts[a:b], ALNUM, b" ", lower=True)
                    codes = library.code(w.hashes())
                    rare = np.bincount(w.doc[library.is_rare[np.maximum(codes, 0)] & (codes > 0)], minlength=b - a)
                    out: list[list] = [[] for _ in range(b - a)]
                    for i in np.flatnonzero(rare).tolist():
                        out[i] = [dict(zip(NAMES, f, strict=True)) for f in library.scan(codes[w.first[i]: w.first[i + 1]])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(w.first)), pa.array(out, kind)],
                                                     names=["key", "n_words", "matches"])

    found = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {df.schema[key].dataType.simpleString()}, n_words long, matches array<{MATCH}>")
    return found.select(F.col("key").alias(key), "n_words", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.license))).alias("licenses"),
                        "matches", F.coalesce(F.array_max(F.transform("matches", lambda m: m.coverage)), F.lit(0.0)).alias("coverage"))
