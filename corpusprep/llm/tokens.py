"""Token ids of a byte-level BPE tokenizer file.

The file (JSON) is the one truth for the ids. Its vocabulary is turned into ranks for a faster encoder
of the same algorithm, which the load proves to be the same model: every merge must rank by its
result's id and the pre-tokenizer must be the plain byte-level one. A file of another kind is run by
the library that reads it.
"""
from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Pre-token pattern of byte-level BPE (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The white space of ``PATTERN`` (Unicode's property) in a run of at least ``LONG`` characters; the encoder's regular expression fails on a million.
LONG = 100_000
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = re.compile(f"(?<![{SPACE}])[{SPACE}]{{{LONG},}}")
PLAIN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(model: dict) -> dict[bytes, int] | None:
    kind = model.get("pre_tokenizer") or {}
    m = model["model"]
    plain = (all(kind.get(k) == v for k, v in PLAIN.items()) and model.get("normalizer") is None and m.get("type", "BPE") == "BPE"
             and not any(m.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    letters, special = byte_letters(), {t["content"] for t in model.get("added_tokens", []) if t.get("special")}
    pairs = [x.split(" ") if isinstance(x, str) else x for x in m["merges"]]
    order = [m["vocab"].get(a + b, -1) for a, b in pairs]
    words = {w: i for w, i in m["vocab"].items() if w not in special}
    if order != sorted(order) or len(words) != len(pairs) + 256 or any(c not in letters for w in words for c in w):
        return None
    return {bytes(letters[c] for c in w): i for w, i in words.items()}


def _by_runs(fast, text: str) -> list[int]:
    """Ids of a text with its long white-space runs cut out at the borders that ``PATTERN`` gives them: a run is one
    pre-token, without its last character if more text follows."""
    if len(text) < LONG:
        return fast.encode_ordinary(text)
    ids, at = [], 0
    for m in LONG_SPACE.finditer(text):
        end = m.end() - (m.end() < len(text))
        ids += fast.encode_ordinary(text[at: m.start()])
        ids += fast._encode_single_piece(text[m.start(): end])
        at = end
    return ids + fast.encode_ordinary(text[at:])


def _added(model: dict) -> dict[str, int] | None:
    """Content -> id of the added tokens, which the library cuts out of a text first; None if some have rules of their own."""
    tokens = model.get("added_tokens", [])
    if any(t.get(rule) for t in tokens for rule in ("lstrip", "rstrip", "single_word")):
        return None
    return {t["content"]: t["id"] for t in tokens if t["content"]}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> uint32 ids, as the library gives them without adding special tokens. The string of an added token is that
    token wherever it stands (leftmost, then longest); what lies between is encoded piece by piece."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    ranks, added = _ranks(model), _added(model)
    if ranks is not None and added is not None:
        import tiktoken

        fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        if not added:
            return lambda text: np.asarray(_by_runs(fast, text), np.uint32)
        cut = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)))

        def encode(text: str) -> np.ndarray:
            ids, at = [], 0
            for m in cut.finditer(text):
                ids += _by_runs(fast, text[at: m.start()])
                ids.append(added[m.group()])
                at = m.end()
            return np.asarray(ids + _by_runs(fast, text[at:]), np.uint32)

        return encode
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    return lambda text: np.asarray(slow.encode(text, add_special_tokens=False).ids, np.uint32)
