"""Context-tree weighting against a direct recursion over contexts, and the unigram base against plain counts."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import contexttree as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) if a + b else 0.0


class Brute:
    """Every node by its definition: (context, bits) -> [zeros, ones]."""

    def __init__(self, texts, depth):
        self.depth, self.n, self.memo = depth, {}, {}
        for t in texts:
            for context, byte in self.symbols(t):
                for d in range(depth + 1):
                    for j in range(8):
                        self.n.setdefault((context[depth - d:], 1 << j | byte >> 8 - j), [0, 0])[byte >> 7 - j & 1] += 1

    def symbols(self, text):
        raw = b"\xff" * self.depth + (text or "").translate(UPPER).encode() + b"\xff"
        return [(raw[i - self.depth: i], raw[i]) for i in range(self.depth, len(raw))]

    def log_w(self, context, bits):
        if (context, bits) not in self.n:
            return 0.0
        if (context, bits) not in self.memo:
            e = log_kt(*self.n[context, bits])
            below = sum(self.log_w(bytes([c]) + context, bits) for c in range(256)) if len(context) < self.depth else None
            self.memo[context, bits] = e if below is None else np.logaddexp(e, below) - math.log(2)
        return self.memo[context, bits]

    def one(self, full, bits, d=0):
        context = full[self.depth - d:]
        a, b = self.n.get((context, bits), (0, 0))
        own = (b + 0.5) / (a + b + 1)
        if d == self.depth or (full[self.depth - d - 1:], bits) not in self.n:
            return own
        w = math.exp(log_kt(a, b) - math.log(2) - self.log_w(context, bits))
        return w * own + (1 - w) * self.one(full, bits, d + 1)

    def log10(self, text):
        out = 0.0
        for context, byte in self.symbols(text):
            for j in range(8):
                p = self.one(context, 1 << j | byte >> 8 - j)
                out += math.log10(p if byte >> 7 - j & 1 else 1 - p)
        return out


def is_held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


def base(rows):
    count = Counter(w for d, t in rows if not is_held(d) for w in [*WORD.findall((t or "").translate(UPPER)), None])
    total, distinct = sum(count.values()), len(count)
    for d, t in rows:
        words = [*WORD.findall((t or "").translate(UPPER)), None]
        yield (str(d), is_held(d), len(words), sum(count[w] > 0 for w in words), total,
               sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words))


def figures(df):
    return sorted((str(r["doc_id"]), not r["trained"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in df.collect())


def test_log_gamma():
    x = np.concatenate((np.arange(1, 400) / 2, [1e6 + 0.5, 1e12]))
    assert np.allclose(C._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-12)


@pytest.fixture(scope="module")
def small():
    import random

    rng = random.Random(8)
    words = ["the", "The", "mère", "a", "of", "wörld", "漢字", "x1"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    rows += [(41, None), (42, ""), (43, " \n"), (None, "null key"), (7, rows[7][1]), (7, rows[7][1]), (44, "ÿ \x00 \x7f unseen 🎉"), (45, "z" * 300)]
    assert any(is_held(d) for d, _ in rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"broadcast_grams": 30, "broadcast_words": 3}, {"broadcast_grams": 0, "broadcast_words": 0}])
def test_scores_equal_the_definition(spark, small, limits):
    df = spark.createDataFrame(small, "doc_id long, text string").select("*", *(F.lit(1).alias(c) for c in ("row", "gram", "word", "n", "id", "train")))
    got = figures(C.score(df.repartition(3), ~C.held_out("doc_id"), depth=3, **limits))
    tree = Brute([t for d, t in small if not is_held(d)], 3)
    want = sorted((*b, tree.log10(t)) for (_, t), b in zip(small, base(small), strict=True))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9), g[0]


def test_next_symbols_sum_to_one():
    """After any context, seen or not, the 256 symbols share all probability."""
    texts = [b"abracadabra", b"abc abd", b"\xc3\xa9t\xc3\xa9"]
    tree = Brute([t.decode() for t in texts], 3)
    for context in (b"abr", b"xbr", b"zzz", b"\xff\xff\xff", b"\xc3\xa9t"):
        total = 0.0
        for byte in range(256):
            p = 1.0
            for j in range(8):
                one = tree.one(context, 1 << j | byte >> 8 - j)
                p *= one if byte >> 7 - j & 1 else 1 - one
            total += p
        assert total == pytest.approx(1.0)


def test_slices_and_long_texts(spark, small, monkeypatch):
    """Grams do not depend on where a long text is cut."""
    texts = [(t or "").encode() for _, t in small]
    whole = [tuple(map(np.concatenate, zip(*C.grams(texts, 4), strict=True)))[0]]
    monkeypatch.setattr(C, "SLICE", 17)
    parts = list(C.grams(texts, 4))
    assert np.array_equal(np.concatenate([k for k, _, _ in parts]), whole[0])
    of = np.concatenate([np.repeat(o, n) for _, o, n in parts])
    assert np.array_equal(np.bincount(of, minlength=len(texts)), [len(t) + 1 for t in texts])


def test_odd_tables(spark, odd, none):
    rows, df = odd
    got = figures(C.score(df, ~C.held_out("doc_id")))
    want = sorted(base(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(g[6] < 0 for g in got)
    assert C.score(none, F.lit(True)).collect() == []
    untrained = C.score(df.where("doc_id < 9"), F.lit(False)).collect()
    assert all(r["score"] == pytest.approx(-8 * r["n_bytes"] * math.log10(2)) and r["n_known"] == 0 for r in untrained)


def test_query_learns_from_text(spark):
    """On the given table, held-out documents get more probability from the context tree than from word counts."""
    from corpusprep.llm.queries import QUERIES

    got = QUERIES["op13_context_tree"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == is_held(r["doc_id"]) for r in got) and len(held) > 50
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert -sum(r["score"] for r in held) / sum(r["n_bytes"] for r in held) / math.log10(2) < 2.3
