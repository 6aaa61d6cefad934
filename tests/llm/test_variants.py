"""Spelling variants against a comparison of all pairs."""
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import variants as V


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(count, ratio=10):
    out, form = {}, {}
    for w, n in count.items():
        others = sorted((x for x in count if near(w, x)), key=lambda x: (-count[x], x))
        form[w] = others[0] if others and count[others[0]] >= ratio * n else None
        out[w] = [n, len(others)]
    for w, row in out.items():
        root = w
        while form[root]:
            root = form[root]
        row += [form[w], root, count.get(form[w])]
    return sorted((w, f, r, n, k, fn) for w, (n, k, f, r, fn) in out.items())


def got(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def vocabulary(rng, letters, size, shortest, longest):
    out = {"".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest))): rng.randint(1, 20) for _ in range(size)}
    for w in list(out)[::2]:  # edits at every place, the ends and inside runs of a letter too
        i = rng.randint(0, len(w))
        out[rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:] or "a", w[:i] + rng.choice(letters) + w[i + 1:]])] = rng.choice([1, 300, 4000])
    return out


@pytest.mark.parametrize("letters,size,shortest,longest,limit", [
    ("ab", 150, 1, 9, 8), ("abcé", 300, 1, 6, 8), ("abcdefgh", 400, 7, 9, 4096), ("aaab", 200, 10, 30, 4), ("aß漢🎉", 150, 2, 5, 8)])
def test_equal_to_all_pairs(spark, letters, size, shortest, longest, limit):
    count = vocabulary(random.Random(size), letters, size, shortest, longest)
    df = spark.createDataFrame(list(count.items()), "word string, n long").repartition(3)
    assert got(V.variants(df, limit=limit)) == brute(count)


def test_large_group_is_cut(spark):
    """Three letters in front of and behind all words: groups above the limit are cut until they are small."""
    rng = random.Random(2)
    count = {"pre" + "".join(rng.choice("abcdefghijkl") for _ in range(4)) + "fix": rng.randint(1, 50) for _ in range(3000)}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    sizes = V.grouped(df, 64).groupBy("group").agg(F.count("*").alias("n"), F.max(F.expr("high - low")).alias("w")).collect()
    assert max(r["n"] for r in sizes if r["w"] > 1) <= 64 and max(r["n"] for r in sizes) <= 12 + 144
    assert got(V.variants(df, limit=64)) == got(V.variants(df)) == brute(count)


def test_blocks_hold_whole_groups(monkeypatch):
    import numpy as np

    rng = random.Random(4)
    words = list(vocabulary(rng, "abc", 500, 7, 9))
    edges = np.array([0, 200, 200 + 70, len(words)])
    length = np.array([len(w) for w in words])
    n = np.arange(len(words))
    word, many, best = V.block_neighbours(words, n, length, np.zeros_like(n), length, edges)
    want = {}
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        for i in range(a, b):
            others = [j for j in range(a, b) if near(words[i], words[j])]
            if others:
                want[i] = (len(others), max(others))
    assert {int(w): (int(k), int(x)) for w, k, x in zip(word, many, best, strict=True)} == want


def test_damaged_words(spark, odd, none):
    rows, df = odd
    rows = [*rows, *((i, "Éveillées ÀÉÎmañana unbelievable×word abcdefg ABCDEFGH") for i in range(100, 160))]
    more = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(c) for c in ("word", "run", "h", "id")))
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    want = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    assert {r["word"]: r["n"] for r in V.damaged_words(more).collect()} == want and len(want) > 5
    assert V.damaged_words(none).collect() == [] and V.damaged_words(df).collect() is not None
    assert V.variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_long_words(spark):
    """Words of thousands of letters, near at both ends and in the middle, and copies of nothing else."""
    rng = random.Random(6)
    base = "".join(rng.choice("abcdef") for _ in range(5000))
    count = {base: 100, base[1:]: 3, base[:-1]: 4, base[:2500] + "z" + base[2501:]: 5, base + "qq": 6, "abcdefg": 2}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    assert got(V.variants(df)) == brute(count)


def test_chains_end_at_the_root(spark):
    """Forms of forms, up to the longest chain that the counts allow."""
    count = {"a" * k + "bcdefgh": 10 ** (k - 1) for k in range(1, 12)}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    rows = got(V.variants(df))
    assert rows == brute(count) and {r[2] for r in rows} == {"a" * 11 + "bcdefgh"}
