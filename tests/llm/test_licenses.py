"""Patience alignment and license scans."""
import random
from itertools import combinations

import numpy as np

from corpusprep.llm.license_texts import TEMPLATES
from corpusprep.llm.licenses import ANY, Library, align, increasing, scan
from corpusprep.llm.textbuf import ALNUM, Words


def test_increasing_is_longest():
    rng = random.Random(1)
    for _ in range(100):
        x = rng.sample(range(30), rng.randint(0, 9))
        got = [x[i] for i in increasing(x)]
        best = max(n for n in range(len(x) + 1) for c in combinations(x, n) if list(c) == sorted(c)) if x else 0
        assert got == sorted(got) and len(got) == best


def test_align():
    assert align([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert align([9, 1, 2, 8, 3], [1, 2, 3]) == [(1, 0), (2, 1), (4, 2)]
    assert align([1, 7, 3], [1, ANY, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert align([5, 5, 5], [5, 5]) == [(0, 0), (1, 1)] and align([], [1]) == []
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(1, 6) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = align(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_every_template_is_found_changed_or_not(spark):
    rng = random.Random(3)
    rows, want = [], []
    noise = lambda n: " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))
    for name, kind, text in TEMPLATES:
        words = text.replace("*", "4").split()
        if kind == "body":  # some words go, some come
            for _ in range(len(words) // 12):
                words[rng.randrange(len(words))] = noise(rng.randint(0, 2))
        rows.append((len(rows), f"{noise(200)}\n{' '.join(words).upper()}\n{noise(300)}"))
        want.append(name)
    rows += [(100, None), (101, ""), (102, noise(3000)), (103, "the of and software license version is the"), (104, rows[0][1]), (104, rows[0][1]), (None, "x")]
    got = scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, matches int").repartition(3)).collect()
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["licenses"] for i in range(len(want))] == [[w] for w in want]
    assert all(by[i]["licenses"] == [] and by[i]["coverage"] == 0 for i in (100, 101, 102, 103, None)) and len(got) == len(rows)
    m = by[0]["matches"][0]
    assert (m["word_start"], m["coverage"]) == (200, 1.0)
    assert scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_two_licenses_in_a_long_text(spark):
    noise = " ".join(f"z{i}" for i in range(100_000))
    text = f"{noise} Released under the MIT License. {noise} Licensed under CC BY-NC 4.0. {noise}"
    r = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["licenses"] == ["CC-BY-NC", "MIT"] and [m["license"] for m in r["matches"]] == ["MIT", "CC-BY-NC"]


def test_any_only_next_to_an_aligned_word():
    assert align([1, 2, 9, 8, 8], [1, 2, ANY]) == [(0, 0), (1, 1), (2, 2)]
    assert align([8, 8, 1, 2], [ANY, 1, 2]) == [(1, 0), (2, 1), (3, 2)]


def found(*texts):
    """(license, first word, words) in each text."""
    library = Library()
    with np.errstate(over="ignore"):
        return [[(f[0], f[3], f[4]) for f in library.scan(library.code(Words([t.encode()], ALNUM, b" ", lower=True).hashes()))] for t in texts]


def test_repeated_licenses():
    rng = random.Random(4)
    noise = lambda n: " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))
    for name, kind, text in TEMPLATES:
        text = text.replace("*", "4")
        size = found(text)[0][0][2]
        for before, gap, times in ((0, 0, 2), (0, 0, 3), (40, 0, 3), (40, 3, 4), (3, size // 2, 5), (40, 2 * size, 3)):
            want = [(name, before + i * (size + gap), size) for i in range(times)]
            joined = "\n".join([noise(before), *(f"{text}\n{noise(gap)}" for _ in range(times)), noise(before)])
            assert found(joined) == [want], (text, before, gap, times)
        if kind == "body":  # other words go in each copy
            words = text.split()
            copies = []
            for i in range(4):
                gone = set(rng.sample(range(3, len(words) - 3), len(words) // 12))
                copies.append(" ".join(w for n, w in enumerate(words) if n not in gone))
            got = found(f"{noise(30)} {' '.join(copies)} {noise(30)}")[0]
            assert [g[0] for g in got] == [name] * 4, text
    assert len(found("Released under the MIT License. " * 20_000)[0]) == 20_000


def test_adjacent_licenses():
    lines = [(name, text.replace("*", "4")) for name, kind, text in TEMPLATES if "*" in text and kind == "line"]
    for one in lines:
        for two in lines:
            for gap in ("", "q1 q2 q3"):
                assert [f[0] for f in found(f"q9 {one[1]} {gap} {two[1]} q8 q7 q6")[0]] == [one[0], two[0]], (one, two)
