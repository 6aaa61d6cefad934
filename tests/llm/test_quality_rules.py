"""Repetition coverage against a plain count of n-grams."""
import re
from collections import Counter

from corpusprep.llm.quality_rules import RepetitionRules, filter_documents, measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules):
    text = text or ""
    w = WORD.findall(text)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    for n in (3, *rules.coverage):
        seen = Counter(tuple(w[i: i + n]) for i in range(len(w) - n + 1))
        inside = {i + k for i in range(len(w) - n + 1) if seen[tuple(w[i: i + n])] > 1 for k in range(n)}
        if n == 3:
            out["n_repeat_words"] = len(inside)
        else:
            out[f"dup_chars_{n}"] = sum(len(w[i]) for i in inside)
    lines, again = set(), []
    for line in text.split("\n"):
        if WORD.search(line):
            if line in lines:
                again.append(line)
            lines.add(line)
    out["n_dup_lines"], out["dup_line_chars"] = len(again), sum(len(x) for line in again for x in WORD.findall(line))
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    good = 100 * out["dup_line_chars"] <= rules.line_coverage * out["word_chars"]
    for n, most in rules.coverage.items():
        good = good and 100 * out[f"dup_chars_{n}"] <= most * out["word_chars"]
    out["kept"] = not out["base_failed"] and good
    return out


def test_measure_equals_brute_force(odd):
    rows, df = odd
    rules = RepetitionRules()
    got = sorted((str(r["doc_id"]), sorted(r.asDict().items())) for r in measure(df).collect())
    assert got == sorted((str(d), sorted({"doc_id": d, **brute(t, rules)}.items())) for d, t in rows)


def test_filter_keeps_rows_and_columns(odd, none):
    rows, df = odd
    out = filter_documents(df)
    assert out.columns == df.columns
    want = sorted(str((d, t)) for d, t in rows if brute(t, RepetitionRules())["kept"])
    assert sorted(str((r["doc_id"], r["text"])) for r in out.collect()) == want and 0 < len(want) < len(rows)
    assert filter_documents(none).collect() == [] and measure(none).collect() == []


def test_equality_is_decided_by_the_text(spark):
    """The Thue-Morse pattern and its complement, for which polynomials modulo a power of two agree: as lines, and as words."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    b = a.translate({97: 98, 98: 97})
    tail = " ".join(f"w{i}" for i in range(60))
    texts = [f"{a}\n{b}\n{tail}", f"{a} x y {b} x y {tail}", f"{a}\n{b}\n{a}\n{tail}", f"{a} x y {a} x y {tail}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = RepetitionRules()
    got = sorted((r["doc_id"], sorted(r.asDict().items())) for r in measure(df).collect())
    assert got == [(i, sorted({"doc_id": i, **brute(t, rules)}.items())) for i, t in enumerate(texts)]
    assert [dict(g)["n_dup_lines"] for _, g in got] == [0, 0, 1, 0] and [dict(g)["n_repeat_words"] for _, g in got] == [0, 0, 0, 6]
