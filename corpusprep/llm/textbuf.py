"""Byte-level text work in NumPy, shared by the operators of this folder.

A run of rows is joined into one UTF-8 buffer with a separator byte after every text, so that one
vectorised pass segments, hashes and compares the words of thousands of texts. Runs are cut at
``RUN_BYTES``; only a single longer text makes a longer run, so memory is bounded by the longest
text, not by the partition. Texts are never cut.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def word_table(not_word: Iterable[int]) -> np.ndarray:
    """256 booleans: which bytes belong to a word."""
    t = np.ones(256, bool)
    t[list(not_word)] = False
    return t


SPACES = (0x20, *range(0x09, 0x0E))
#: Words of `[^\x20\x09-\x0D]+`.
BY_SPACE = word_table(SPACES)
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: digits, a-z, and all beyond ASCII.
ALNUM = word_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every row; a null is an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b if b is not None else b"" for b in column.cast(kind).to_pylist()]


def squeezed(df, text: str):
    """``df`` with its string column ``text`` packed as zstd bytes, for a narrower shuffle; nulls are empty texts."""
    import pyspark.sql.types as T
    import zstandard

    place = df.columns.index(text)
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == text else f.dataType) for f in df.schema])

    def pack(batches):
        for batch in batches:
            squeeze = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
            columns = list(batch.columns)
            columns[place] = pa.array([squeeze(t) for t in text_bytes(columns[place])], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(pack, schema)


def unsqueezed(column: pa.Array) -> list[bytes]:
    import zstandard

    back = zstandard.ZstdDecompressor().decompress
    return [back(b) for b in column.to_pylist()]


def runs(texts: list[bytes], size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together hold about ``size`` bytes (one row at least)."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > size:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, RUN_BYTES + 4096)
        with np.errstate(over="ignore"):
            for k, b in enumerate((_BASE, _INVERSE)):
                p = np.full(n, b, U64)
                p[0] = 1
                _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash, one longer than ``values``."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values.astype(U64) * _powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every span of the values behind ``prefix``; equal spans have equal hashes."""
    inverse = _powers(len(prefix))[1]
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


class Words:
    """The words of a run of texts.

    ``starts``/``ends``: byte spans in ``buf``; ``doc``: row (from 0) of each word; ``first``: index of
    each row's first word, with the number of words at the end; ``origin``: where each row begins.
    """

    def __init__(self, texts: list[bytes], table: np.ndarray, sep: bytes = b"\n", lower: bool = False):
        raw = sep.join(texts) + sep
        self.buf = np.frombuffer(raw, np.uint8)
        if lower:
            self.buf = LOWER[self.buf]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.origin = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths + 1, out=self.origin[1:])
        self.table = table
        inside = table[self.buf].view(np.int8)
        edge = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))  # the last byte is a separator: edges come in pairs
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.origin)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def strings(self) -> pa.Array:
        """The words as binary strings."""
        offsets = np.concatenate(([0], np.cumsum(self.ends - self.starts))).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.buf[self.table[self.buf]])])

    def codes(self) -> np.ndarray:
        """A number for every word, the same for equal words only."""
        return self.strings().dictionary_encode().indices.to_numpy(zero_copy_only=False)

    def hashes(self) -> np.ndarray:
        return span_hash(prefix_hash(self.buf), self.starts, self.ends)


def code_points(buf: np.ndarray) -> np.ndarray:
    """Prefix counts of code points, one longer than ``buf``."""
    out = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out


def duplicated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur at least twice."""
    out = np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys)
        k = keys[order]
        eq = k[1:] == k[:-1]
        out[order[1:][eq]] = True
        out[order[:-1][eq]] = True
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``width`` that begins at one of ``starts``."""
    d = np.bincount(starts, minlength=n + 1)
    if width <= n:
        d[width:] -= d[: n + 1 - width].copy()
    return np.cumsum(d[:n]) > 0
