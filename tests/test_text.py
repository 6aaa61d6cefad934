"""Text functions agree with Python's str methods, repr and json on fixture and adversarial rows."""
import hashlib
import json

from pyspark.sql import functions as F

from samples import ADVERSARIAL
from corpusprep.functions import text as T


def _frame(spark, pairs):
    return spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(pairs)], "row_key long, src string, tgt string")


def _py(s, t):
    ss, tt = s.strip(), t.strip()
    idx = hashlib.sha1(repr({"src": ss, "tgt": tt}).encode("utf-8")).hexdigest()[:12]
    words = s.split() + t.split()
    pid = hashlib.sha1(json.dumps(words, sort_keys=True, separators=(",", ":")).encode("utf-8")).hexdigest()[:8]
    return len(s.split()), len(t.split()), ss, tt, idx, pid, max(len(s.split()), len(t.split()) + 1)


def _check(spark, pairs):
    df = _frame(spark, pairs)
    out = df.select(
        "row_key",
        T.word_count("src").alias("sl"), T.word_count("tgt").alias("tl"),
        T.strip_text("src").alias("ss"), T.strip_text("tgt").alias("ts"),
        T.content_idx(T.strip_text("src"), T.strip_text("tgt")).alias("idx"),
        T.pair_id("src", "tgt").alias("pid"),
        T.max_len(T.word_count("src"), T.word_count("tgt")).alias("ml"),
    ).orderBy("row_key").collect()
    for r, (s, t) in zip(out, pairs):
        assert (r.sl, r.tl, r.ss, r.ts, r.idx, r.pid, r.ml) == _py(s, t), (s, t)


def test_adversarial_parity(spark):
    pairs = [(a, b) for a in ADVERSARIAL for b in ADVERSARIAL[:4]]
    _check(spark, pairs)


def test_fixture_parity(spark, rows64):
    _check(spark, [(r["en"], r["fr"]) for r in rows64])


def test_known_hashes(spark):
    got = _frame(spark, [("a b", "c d")]).select(T.content_idx("src", "tgt").alias("idx"), T.pair_id("src", "tgt").alias("pid")).first()
    assert got.idx == hashlib.sha1(b"{'src': 'a b', 'tgt': 'c d'}").hexdigest()[:12]
    assert got.pid == hashlib.sha1(b'["a","b","c","d"]').hexdigest()[:8]


def test_space_only_split_is_wrong(spark, rows64):
    df = _frame(spark, [(r["en"], r["fr"]) for r in rows64])
    diff = df.where(T.word_count("tgt") != F.size(F.filter(F.split("tgt", " "), lambda x: x != ""))).count()
    assert diff == sum(len(r["fr"].split()) != len([x for x in r["fr"].split(" ") if x]) for r in rows64) > 0


def test_py_round_ratio_matches_python(spark):
    cases = [(s, n) for n in (1, 2, 3, 7, 16, 80, 128, 400, 1000, 2000, 12345) for s in range(0, 2 * n + 3, max(1, n // 50))]
    cases += [(1, 80), (1, 2000), (5, 400), (25, 2000), (361, 16), (24297 * 2 + 1, 2000)]
    df = spark.createDataFrame(cases, "s long, n long")
    got = df.select("s", "n", T.py_round_ratio("s", "n", 3).alias("r")).collect()
    for row in got:
        assert row.r == round(row.s / row.n, 3), (row.s, row.n, row.r)


def test_null_text_counts_as_empty(spark):
    df = spark.createDataFrame([(1, None)], "k long, s string")
    assert df.select(T.word_count("s").alias("c")).first().c == 0


def test_words_are_cut_without_a_regular_expression(spark):
    """A regular expression over the whitespace class took ten times as long, more than all else of a scan."""
    odd = ["", " ", "a", " a  b\n", "\x00 a\x00b", "x" + T.WHITESPACE_CHARS + "y\u200b z", "\x1c\x85a\U0001f389\u3000b", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(odd)], "i int, s string").select("i", T.words("s").alias("w"), T.word_count("s").alias("n"))
    assert {r.i: (r.w, r.n) for r in df.collect()} == {i: ((s or "").split(), len((s or "").split())) for i, s in enumerate(odd)}
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_the_words_of_a_pair_id_are_joined_once(spark):
    df = spark.createDataFrame([("a b", "c")], "s string, t string").select(T.pair_id("s", "t").alias("id"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("coalesce(") == 2  # each side is read once
