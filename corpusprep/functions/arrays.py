"""Array column expressions for collation (H1-H5, H7) and casts (C11).

All built-in array functions: no Python per row.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _len(length) -> Column:
    return length if isinstance(length, Column) else F.lit(int(length))


def pad_truncate(ids, length, pad_id: int) -> Column:
    """H1: keep the first ``length`` ids and right-pad with ``pad_id`` up to ``length``."""
    L = _len(length)
    return F.slice(F.concat(_c(ids), F.array_repeat(F.lit(pad_id), L)), 1, L)


def decoder_input(padded, length, bos_id: int) -> Column:
    """H2: ``[BOS] + t[:L-1]``."""
    L = _len(length)
    return F.concat(F.array(F.lit(bos_id)), F.slice(_c(padded), 1, L - 1))


def labels(padded, length, eos_id: int) -> Column:
    """H3: ``t[:L-1] + [EOS]`` on the *padded* row, so EOS lands after the padding (as the reference)."""
    L = _len(length)
    return F.concat(F.slice(_c(padded), 1, L - 1), F.array(F.lit(eos_id)))


def labels_eos_after_text(ids, length, pad_id: int, eos_id: int) -> Column:
    """H3 opt-in: EOS right after the text, then padding."""
    L = _len(length)
    return pad_truncate(F.concat(F.slice(_c(ids), 1, L - 1), F.array(F.lit(eos_id))), L, pad_id)


def attention_mask(a, pad_id: int) -> Column:
    """H4: true where the id is not the pad id."""
    return F.transform(_c(a), lambda x: x != F.lit(pad_id))


def pad_to(a, length, pad_id: int) -> Column:
    """Right-pad (never truncate) to ``length``: H5 with a batch maximum as the length."""
    L = _len(length)
    return F.concat(_c(a), F.array_repeat(F.lit(pad_id), F.greatest(L - F.size(_c(a)), F.lit(0))))


def next_token_pairs(tokens, t: int) -> tuple[Column, Column]:
    """H7: ``x = t[:T]``, ``y = t[1:T+1]``."""
    return F.slice(_c(tokens), 1, t), F.slice(_c(tokens), 2, t)


def as_int32(a) -> Column:
    return _c(a).cast("array<int>")


def as_int64(a) -> Column:
    """C11: pre-tokenised fields as 64-bit vectors."""
    return _c(a).cast("array<bigint>")


def char_ids(text, offset: int = 5) -> Column:
    """Character-level stand-in token ids (code point + offset): used where the collation
    operators are checked without a learned vocabulary."""
    return F.transform(F.split(F.coalesce(_c(text), F.lit("")), ""), lambda ch: F.ascii(ch) + F.lit(offset))
