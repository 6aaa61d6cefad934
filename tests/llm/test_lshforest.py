"""The similarity join against all pairs."""
import random
import re
from dataclasses import replace

import numpy as np
import pytest

from corpusprep.llm.lshforest import Forest, _link, _ranges, deduplicate, exact_links, grams, join
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(t, n=5):
    w = WORD.findall(t or "")
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute(rows, limit=0.8):
    s = [sets(t) for _, t in rows]
    root, n = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and both >= limit * (len(s[i]) + len(s[j]) - both) - 1e-9:
                n[i] += 1
                n[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    order = lambda k: (rows[k][0] is not None, rows[k][0] or 0)
    heads = {}
    for i in range(len(rows)):
        heads[top(i)] = min(heads.get(top(i), i), i, key=order)
    return [(str(rows[i][0]), str(rows[heads[top(i)]][0]), n[i]) for i in range(len(rows))], [top(i) for i in range(len(rows))]


def corpus():
    rng = random.Random(4)
    rows = []
    for g in range(6):
        base = WORD.findall(prose(rng, 120))
        for _ in range(9):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            rows.append((len(rows), rng.choice([" ", "\n"]).join(w)))
    order = [7, 3, 9, 1, 8, 0, 5, 2, 6, 4]  # a chain: each text is like its neighbours only, in no order of keys
    long = WORD.findall(prose(rng, 150))
    chain = [" ".join(long[k * 7: k * 7 + 75]) for k in range(10)]
    rows += [(len(rows) + i, chain[k]) for i, k in enumerate(order)]
    return rows + [(len(rows) + i, prose(rng, n)) for i, n in enumerate([0, 1, 4, 5, 6, 50])]


def test_join_equals_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, _ = brute(rows)
    assert sum(r[2] for r in want) > 60
    for forest in (Forest(), replace(Forest(), tile_rows=3, group_rows=4, all_pairs=2), replace(Forest(), depths=(1, 2, 3), recall=0.999999)):  # and with every group split, and with crowded branches
        got = join(df, forest=forest).collect()
        assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == sorted(want)


def test_odd_rows(odd, none):
    rows, df = odd
    want, root = brute(rows)
    got = join(df).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == sorted(want)
    out = deduplicate(df)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(kept) == len(set(root))
    assert {sets(t) == set() for _, t in kept} == {True, False}
    assert join(none).collect() == [] and deduplicate(none).collect() == []


def test_every_class_reaches_the_recall():
    f = Forest()
    rng = np.random.default_rng(2)
    short = np.where(rng.random((300, f.trees)) < 0.4, rng.integers(2, 10 ** rng.integers(1, 7, (300, 1)), (300, f.trees)), 1)
    sizes = np.stack((short, np.minimum(short, rng.integers(1, 50, short.shape))), axis=2)
    level = f.chosen(sizes)
    depth = np.array(f.depths)[level]
    assert ((1 - 0.8 ** depth).prod(axis=1) <= 1 - f.recall + 1e-12).all()
    assert (level[short == 1] == 0).all() and set(level.ravel().tolist()) == {0, 1, 2}
    met = np.where(level == 0, short, np.where(level == 1, sizes[:, :, 1], 1)).sum(axis=1)
    assert met.sum() < short.sum() / 2  # crowded branches are left out where others make up for them
    alone = f.chosen(np.ones((1, f.trees, 2), np.int64))
    assert (alone == 0).all()
    for bad in (dict(trees=1), dict(depths=(5, 4, 7))):
        with pytest.raises(ValueError):
            replace(f, **bad)


def test_ranges_of_a_sorted_trie():
    rng = np.random.default_rng(3)
    path = np.array(sorted(map(tuple, rng.integers(0, 3, (60, 3)).tolist())))
    label, tail = path[:, 0], ((path[:, 1] << 32) | path[:, 2]).astype(np.uint64)
    level = rng.integers(0, 3, len(path))
    met = set()
    for number, begin, end in _ranges(label, tail, level):
        for lo, hi in zip(begin, end):
            met |= {(i, j) for i in range(lo, hi) if level[i] == number for j in range(lo, hi) if i != j}
    same = lambda i, j: (path[i, : level[i] + 1] == path[j, : level[i] + 1]).all()
    assert met == {(i, j) for i in range(60) for j in range(60) if i != j and same(i, j)}


def test_leaders_link_what_all_pairs_link():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 60000, (5, 120)).astype(np.uint16)
    signature = np.repeat(base, 60, axis=0)
    swap = rng.random(signature.shape) < 0.08
    signature[swap] = rng.integers(0, 60000, int(swap.sum()))
    every, half = np.ones(300, bool), np.arange(300) % 2 == 0
    full, few, some = (_link(signature, asks, replace(Forest(), all_pairs=n)) for asks, n in ((every, 10_000), (every, 1), (half, 1)))
    for got in (few, some):
        assert len(set(full.tolist())) == 5 and [full[i] == full[j] for i in range(300) for j in (0, 70, 140)] == [got[i] == got[j] for i in range(300) for j in (0, 70, 140)]


def test_exact_links_both_ways():
    rng = np.random.default_rng(1)
    every = [np.unique(np.concatenate((np.arange(k // 4 * 50, k // 4 * 50 + 40), rng.integers(10_000, 20_000, k % 4))).astype(np.uint64)) for k in range(40)]
    same = lambda x, y: len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) - 1e-9
    for i, hits in exact_links(every, None, 0.8):
        assert hits.tolist() == [j for j in range(40) if j != i and same(every[i], every[j])]
    for i, hits in exact_links(every[:15], every[15:], 0.8):
        assert hits.tolist() == [j for j in range(25) if same(every[i], every[15 + j])]


def test_grams_are_distinct():
    texts = [b"a b c d e f a b c d e", b"", b"x y", b"a b c d e"]
    with np.errstate(over="ignore"):
        key, first = grams(texts, 5)
    assert np.diff(first).tolist() == [len(sets(t.decode())) for t in texts]
    assert key[first[3]] in key[: first[1]]
