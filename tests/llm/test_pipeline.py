"""Every stage of the pipeline against brute force, on odd rows."""
import re

import corpus_pipeline
from corpusprep.llm import quality_rules
from tests.llm.conftest import prose
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_lshforest import brute as similar
from tests.llm.test_quality_rules import brute as measured

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, tmp_path):
    import random

    rng = random.Random(8)
    base = [prose(rng, rng.randint(60, 150)) for _ in range(16)]
    passage = prose(rng, 70)
    item = prose(rng, 30)
    texts = [*base, base[0], base[1] + " end", None, "", "few words", "la " * 100, prose(rng, 90) + " " + passage, passage + "\n" + prose(rng, 90) + "!", prose(rng, 80) + " " + item + " " + prose(rng, 9)]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[6])
    sf = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_forest", "suffix_repeats", "decontaminate", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, [(r[0], r[1]) for r in rows]
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / f"o{i}"))
        docs = spark.read.parquet(str(tmp_path / f"o{i}"))
        out.append([tuple(r) for r in docs.collect()])
        if i < 4:
            assert docs.columns == columns
    rules = quality_rules.RepetitionRules()
    left = [r for r in left if measured(r[1], rules)["kept"]]
    assert sorted(r[:2] for r in out[0]) == sorted(left)
    _, root = similar(left)
    kept = {}
    for r, g in zip(left, root, strict=True):
        kept[g] = min(kept.get(g, r), r)
    assert sorted(r[:2] for r in out[1]) == sorted(kept.values()) and len(kept) < len(left)
    words = lambda rows: [w for r in rows for w in WORD.findall(r[1])]
    assert set(words(out[2])) == set(words(out[1])) and len(words(out[1])) - len(words(out[2])) == 70
    assert all(r[4] == len(r[1]) for r in out[2])
    gone = {r[0] for r in contaminated([r[:2] for r in out[2]], [(1, item)]) if r[4]}
    assert gone == {"24"} and sorted(r[0] for r in out[3]) == sorted(r[0] for r in out[2] if str(r[0]) not in gone)
    assert {r[0] for r in out[4]} == {r[0] for r in out[3]}
    assert corpus_pipeline.run(spark, sf).count() == len(out[4])


def test_stages_take_empty_tables(spark, tmp_path):
    sf = str(tmp_path / "sf")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).collect() == []
