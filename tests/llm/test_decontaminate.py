"""Suffix-array search against a comparison of all windows."""
import random
import re

from corpusprep.llm.decontaminate import find, judge, remove
from tests.llm.conftest import prose

LOW = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items):
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, text in items:
            x = words(text)
            n = min(13, len(x))
            for a in range(len(x) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b: b + n] == x[a: a + n]:
                        hit.update(range(b, b + n))
                        ids.add(str(i))
        out.append((str(d), len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def table(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, n, 30)) for i, n in enumerate([0, 1, 4, 13, 20, 40, 40, 60])]
    items += [(20, items[5][1]), (21, None), (22, "Solo, word!")]
    docs = []
    for d in range(40):
        text = prose(rng, rng.randint(0, 60), 30)
        if d % 3 == 0:
            x = rng.choice(items)[1] or ""
            cut = x.split(" ")
            a = rng.randint(0, max(0, len(cut) - 14))
            text += " " + " ".join(cut[a: a + rng.randint(5, 40)]).upper() + ", " + prose(rng, rng.randint(0, 20), 30)
        docs.append((d, text))
    docs += [(50, None), (51, ""), (52, items[7][1]), (52, items[7][1]), (None, "a SOLO word. b")]
    return docs, items


def test_find_equals_brute_force(spark):
    docs, items = table(spark)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert any(r[2] for r in want)
    for block in (1 << 20, 700):  # one block, and several
        got = judge(find(df, bench, block_bytes=block)).collect()
        assert sorted((str(r["c0"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got) == want
    text = {str(i): words(t) for i, t in items}
    for r in got:  # matches are verbatim and maximal
        w = words(r["c1"])
        for m in r["matches"]:
            x, a, b, n = text[m["item_id"]], m["doc_start"], m["item_start"], m["n_words"]
            assert w[a: a + n] == x[b: b + n]
            assert a == 0 or b == 0 or w[a - 1] != x[b - 1] or n < 13
            assert a + n == len(w) or b + n == len(x) or w[a + n] != x[b + n]


def test_remove_odd_rows(spark, odd, none):
    rows, df = odd
    bench = spark.createDataFrame([(1, rows[2][1] or ""), (2, None)], "item_id long, text string")
    out = remove(df, bench)
    assert out.columns == df.columns
    gone = {r[0] for r in brute(rows, [(1, rows[2][1])]) if r[4]}
    assert gone and sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(d) for d, _ in rows if str(d) not in gone)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert remove(df, empty).count() == len(rows)
    assert remove(none, bench).collect() == []
