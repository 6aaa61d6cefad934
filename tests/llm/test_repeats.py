"""Repeated passages against a brute-force search over all windows."""
import random
import re

from corpusprep.llm.repeats import Passages, remove, spans, without

P = Passages(min_words=12, sample=5, order_words=2)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n):
    """Places (doc, word) inside a window of n words that occurs again."""
    seen = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - n + 1):
            seen.setdefault(tuple(w[i: i + n]), []).append((doc, i))
    again = set()
    for found in seen.values():
        first = {}
        for d, i in sorted(found):
            first.setdefault(d, i)
        if len(first) > 1 or any(i - first[d] >= n for d, i in found):
            again.update((d, i + k) for d, i in found for k in range(n))
    return again


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
            words += rng.choice(shared) if rng.random() < 0.5 else []
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(60, "a " * 100), (61, None), (62, ""), (63, rows[3][1]), (64, "é " * 5 + "a " * 30)]
    return rows


def places(found, copies):
    return {(r["doc_id"], r["word_start"] + k) for r in found if r["copy"] or not copies for k in range(r["n_words"])}


def test_spans_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = spans(df, passages=P).collect()
    again = brute(rows, P.min_words)
    assert again
    # equal texts are compared with others through one of them
    heads = {}
    for d, t in rows:
        heads.setdefault(t, d)
    got = places(found, False)
    for d, t in rows:
        if heads[t] == d:
            assert {w for e, w in got if e == d} == {w for e, w in again if e == d}, d
    words = {d: WORD.findall(t or "") for d, t in rows}
    copies = places(found, True)
    left = {}
    for d, w in words.items():
        for i in range(len(w) - P.min_words + 1):
            if not any((d, i + k) in copies for k in range(P.min_words)):
                left.setdefault(tuple(w[i: i + P.min_words]), []).append((d, i))
    for kept in left.values():  # what is left has no passage twice
        assert len({d for d, _ in kept}) == 1


def test_many_batches_in_a_task(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    df = spark.createDataFrame(corpus(), "doc_id long, text string").coalesce(1)
    want = sorted(map(str, spans(df, passages=P).collect()))
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 2)
        assert sorted(map(str, spans(df, passages=P).collect())) == want
    finally:
        spark.conf.set(name, before)


def test_remove_keeps_owner_and_columns(spark):
    rows = [(d, t, None if t is None else len(t), "x", 1) for d, t in corpus()]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, row string, copy int").repartition(3)
    out = {r["doc_id"]: r for r in remove(df, passages=P).collect()}
    assert remove(df, passages=P).columns == df.columns
    copies = places(spans(df, passages=P).collect(), True)
    kept = set()
    for d, t, *_ in rows:
        words = WORD.findall(t or "")
        left = [w for i, w in enumerate(words) if (d, i) not in copies]
        kept.update(left)
        if words and not left:
            assert d not in out
        elif t is None:
            assert out[d]["text"] is None
        else:
            assert WORD.findall(out[d]["text"]) == left
            assert out[d]["n_chars"] == len(out[d]["text"])
    assert kept == {w for _, t, *_ in rows for w in WORD.findall(t or "")}


def test_without():
    assert without("a  b c\nd", [(1, 2)]) == "a  d"
    assert without("a b c", [(0, 2), (1, 2)]) == ""
    assert without("a b c", [(2, 1)]) == "a b"


def test_empty_null_keys_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert spans(spark.createDataFrame([], schema), passages=P).collect() == []
    assert remove(spark.createDataFrame([], schema), passages=P).collect() == []
    text = " ".join(f"u{i}" for i in range(20))
    same = spark.createDataFrame([(1, text), (1, text), (None, text)], schema)
    assert {(r["doc_id"], r["first_doc_id"], r["copy"]) for r in spans(same, passages=P).collect()} == {(1, 1, False), (None, 1, True)}
    assert len(remove(same, passages=P).collect()) == 2
