"""Stage configurations and their fingerprints (dataset identity).

A configuration is a small frozen dataclass held on the driver. Its *stable* fields, plus a
format version ``_v``, are serialised as compact JSON with sorted keys; the first 8 hex digits of
the SHA-1 of that text are the dataset id, and the id ends the dataset name.
"""
from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass, field, fields

# Version and length that dataset ids depend on.
FINGERPRINT_VERSION = 1
ID_DIGITS = 8


def _stable(default):
    return field(default=default, metadata={"stable": True})


@dataclass(frozen=True)
class BaseConfig:
    # Fixed defaults of the reference's configuration (identity depends on them).
    source: str = _stable("HuggingFace")
    source_dataset_name: str = _stable("wmt14")
    source_dataset_url: str = _stable("https://huggingface.co/datasets/wmt/wmt14")
    split: str = _stable("train")
    n: int = _stable(50000)

    @property
    def dataset_id(self) -> str:
        """Short name of the configuration: the same for two configurations whose identity fields agree."""
        identity = {"_v": FINGERPRINT_VERSION, **{f.name: getattr(self, f.name) for f in fields(self) if "stable" in f.metadata}}
        canonical = json.dumps(identity, separators=(",", ":"), sort_keys=True).encode()
        return hashlib.sha1(canonical).hexdigest()[:ID_DIGITS]

    @property
    def fingerprint(self) -> str:
        return self.dataset_id

    @property
    def dataset_name(self) -> str:
        """``<source name>-<languages>-<split>-<stage>-<n>_examples-<id>``."""
        parts = (self.source_dataset_name, self.lang, self.split, self.stage, f"{self.n}_examples", self.dataset_id)
        return "-".join(parts)

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class RawConfig(BaseConfig):
    """Extraction: which source, language pair and split; seeded shuffle; sample size ``n``."""

    # Field names and defaults (identity depends on them).

    lang: str = _stable("fr-en")
    lang_src: str = _stable("en")
    lang_tgt: str = _stable("fr")
    shuffle: bool = _stable(True)
    buffer_size: int = _stable(30000)
    stage: str = _stable("raw")
    seed: int = _stable(42)


@dataclass(frozen=True)
class FilterConfig(BaseConfig):
    """Filtering: word-count bounds, length ratio, special-token flags, first-``n`` selection.

    ``ratio_min`` is part of the identity but, as in the reference, never applied.
    ``tokens_min``/``tokens_max`` bound *word* counts.
    """

    # Field names and defaults (identity depends on them).

    lang: str = _stable("fr-en")
    lang_src: str = _stable("en")
    lang_tgt: str = _stable("fr")
    tokens_min: int = _stable(4)
    tokens_max: int = _stable(64)
    ratio_min: float = _stable(0.5)
    ratio_max: float = _stable(2.0)
    src_bos: bool = _stable(False)
    src_eos: bool = _stable(False)
    tgt_bos: bool = _stable(True)
    tgt_eos: bool = _stable(False)
    lbl_bos: bool = _stable(False)
    lbl_eos: bool = _stable(True)
    stage: str = _stable("filtered")
    seed: int = _stable(42)

    @classmethod
    def from_config(cls, cfg: BaseConfig, **overrides) -> "FilterConfig":
        """The filter settings for a raw set: where its rows come from is kept, all else is this class's default or given."""
        origin = ("source", "source_dataset_name", "source_dataset_url", "split")
        return cls(**({name: getattr(cfg, name) for name in origin} | overrides))

    def word_cap(self, *specials: bool, tokens_per_word: float = 1.3, reserve: int = 8) -> int:
        """Words that fit the token limit beside the special tokens and a reserve; 1 at least."""
        return max(1, math.floor((self.tokens_max - sum(specials) - reserve) / tokens_per_word))

    @property
    def src_max_words(self) -> int:
        return self.word_cap(self.src_bos, self.src_eos)

    @property
    def tgt_max_words(self) -> int:
        return self.word_cap(self.tgt_bos, self.tgt_eos)


@dataclass(frozen=True)
class VocabConfig:
    """BPE learning parameters (deployed values: 30000 tokens, min frequency 2)."""

    vocab_size: int = 30000
    min_frequency: int = 2
    # The special tokens in id order, and the unknown token.
    special_tokens: tuple = ("<PAD>", "<UNK>", "<BOS>", "<EOS>", "<MASK>")
    unk_token: str = "<UNK>"

    def validate(self) -> None:
        for name in ("vocab_size", "min_frequency"):
            value = getattr(self, name)
            if value is None:
                raise ValueError(f"{name} must be given")
            if type(value) is not int:
                raise TypeError(f"{name} has to be an integer, not {value!r}")
            if value < 1:
                raise ValueError(f"{name} has to be positive, not {value}")
        if not self.special_tokens:
            raise ValueError("at least one special token is needed")
        if any(not isinstance(t, str) or t == "" for t in self.special_tokens):
            raise TypeError(f"special tokens are non-empty strings, not {self.special_tokens!r}")
        if self.unk_token not in self.special_tokens:
            raise ValueError(f"{self.unk_token!r} is not among the special tokens")
