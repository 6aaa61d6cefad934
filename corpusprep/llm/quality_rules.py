"""Quality rules by repetition coverage.

For several n-gram lengths, a rolling hash over the words of a text (in NumPy, whole runs of texts at
once; words are numbered exactly, by a dictionary of the run) finds the n-grams that occur twice or more in it. The rule measures which share of the words'
characters lies inside such n-grams, and which inside lines equal to an earlier line. The lengths are
nested: an n-gram can only repeat where its (n-1)-grams repeat, so each longer length looks at the
places left by the shorter one. Texts of natural length hardly repeat five words, so texts above a
limit are templates, loops or spam.

One pass over the scan, no shuffle. Texts are never cut; memory follows the longest text.

Defined cases: a null or empty text has no words and fails the base rule; repeated rows get a row
each; extra columns are ignored by ``measure`` and kept by ``filter_documents``.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusprep.llm.textbuf import (
    BY_SPACE, U64, Words, code_points, covered, duplicated, mix, prefix_hash, runs, span_hash, text_bytes,
)

SYMBOLS = b"#*$%&|<>"
ROLL = U64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits. ``coverage``: for a length n, the greatest share (per cent) of word characters that may
    lie inside n-grams found twice or more; ``line_coverage``: the same inside repeated lines."""

    min_words: int = 50
    max_repeat_words: int = 50
    coverage: dict[int, int] = field(default_factory=lambda: {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10})
    line_coverage: int = 20


def _rolling(words: Words, hashes: np.ndarray, longest: int, shortest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, starts of the n-grams that occur twice or more in their own text) from ``shortest`` on."""
    end = words.first[1:][words.doc] if len(hashes) else words.doc
    at = np.arange(len(hashes))
    salt = mix(words.doc.astype(U64) + U64(1))
    gram = np.zeros(len(hashes), U64)
    for n in range(1, longest + 1):
        fits = at + n <= end[at]
        at, gram = at[fits], gram[fits]
        gram = gram * ROLL + hashes[at + n - 1]
        if n >= shortest:
            twice = duplicated(mix(gram) ^ salt[at])
            at, gram = at[twice], gram[twice]
            yield n, at


def measure_texts(texts: list[bytes], rules: RepetitionRules) -> dict[str, np.ndarray]:
    """The figures of every text of one run."""
    n = len(texts)
    w = Words(texts, BY_SPACE)
    points = code_points(w.buf)
    size = points[w.ends] - points[w.starts]
    per = lambda where, weights=None: np.bincount(where, weights=weights, minlength=n).astype(np.int64)
    out = {"n_words": np.diff(w.first), "word_chars": per(w.doc, size)}
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    row = lambda places: np.searchsorted(w.origin, places, side="right") - 1
    out["n_symbols"] = per(row(np.flatnonzero(symbol[w.buf])))

    breaks = np.flatnonzero(w.buf == 0x0A)  # the separator is a line break too
    begins = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
    low, high = np.searchsorted(w.starts, begins), np.searchsorted(w.starts, breaks)
    real = high > low
    begins, stops, low, high = begins[real], breaks[real], low[real], high[real]
    of = row(begins)
    key = span_hash(prefix_hash(w.buf), begins, stops) ^ mix(of.astype(U64) + U64(1))
    later = np.zeros(len(key), bool)
    seen: set[tuple[int, bytes]] = set()
    for i in np.flatnonzero(duplicated(key)):  # equal hashes: the lines themselves decide
        line = (int(of[i]), w.buf[begins[i]: stops[i]].tobytes())
        later[i] = line in seen
        seen.add(line)
    out["n_dup_lines"] = per(of[later])
    sums = np.concatenate(([0], np.cumsum(size)))
    out["dup_line_chars"] = per(of[later], (sums[high] - sums[low])[later])

    longest = max([3, *rules.coverage])
    for length, at in _rolling(w, mix(w.codes().astype(U64) + U64(1)), longest, 3):
        if length == 3 or length in rules.coverage:
            inside = covered(at, length, len(size))
            if length == 3:
                out["n_repeat_words"] = per(w.doc[inside])
            if length in rules.coverage:
                out[f"dup_chars_{length}"] = per(w.doc[inside], size[inside])
    return out


def figures(rules: RepetitionRules) -> list[str]:
    return ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
            *(f"dup_chars_{n}" for n in sorted(rules.coverage))]


def verdicts(got: dict[str, np.ndarray], rules: RepetitionRules) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of every text."""
    base = (got["n_words"] < rules.min_words) | (100 * got["n_repeat_words"] > rules.max_repeat_words * got["n_words"])
    ok = 100 * got["dup_line_chars"] <= rules.line_coverage * got["word_chars"]
    for n, most in rules.coverage.items():
        ok &= 100 * got[f"dup_chars_{n}"] <= most * got["word_chars"]
    return base, ok & ~base


def measure(df: DataFrame, key: str = "doc_id", text: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """One row per input row: ``key``, every figure, ``base_failed`` and ``kept``."""
    rules = rules or RepetitionRules()
    names = figures(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(1))
                for a, b in runs(texts):
                    got = measure_texts(texts[a:b], rules)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), *(pa.array(got[n], pa.int64()) for n in names),
                         *map(pa.array, verdicts(got, rules))], names=[key, *names, "base_failed", "kept"])

    schema = (f"`{key}` {df.schema[key].dataType.simpleString()}, "
              + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean")
    return df.select(key, text).mapInArrow(scan, schema)


def filter_documents(df: DataFrame, text: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """The rows of ``df``, with all its columns, whose text passes the rules."""
    rules = rules or RepetitionRules()
    place = df.columns.index(text)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(place))
                kept = [verdicts(measure_texts(texts[a:b], rules), rules)[1] for a, b in runs(texts)]
                if kept:
                    yield batch.filter(pa.array(np.concatenate(kept)))

    return plain.mapInArrow(scan, plain.schema).toDF(*df.columns)
