"""Catalog scenarios and the extraction / filtering jobs (the reference's repo and builder tests)."""
import pytest

from corpusprep.config import FilterConfig, RawConfig
from corpusprep.plans import jobs as JB
from corpusprep.plans.catalog import Catalog, DataCorruptionError
from corpusprep.session import delete_path, shared_path
from corpusprep.sources import jsonl as J


def test_fingerprints():
    assert RawConfig(split="test", n=64).fingerprint == "6ff6609f"
    assert FilterConfig().fingerprint == "62438e4e"
    assert FilterConfig(n=8).fingerprint == "e95bf942"
    assert RawConfig(split="test", n=64).dataset_name == "wmt14-fr-en-test-raw-64_examples-6ff6609f"
    assert FilterConfig().src_max_words == 43 and FilterConfig().tgt_max_words == 42


@pytest.fixture(scope="module")
def source(spark, rows64):
    """A file as users have it: language columns only, no key."""
    path = shared_path(spark, "fixture64")
    J.write_jsonl_exclusive(spark.createDataFrame([(r["en"], r["fr"]) for r in rows64], "en string, fr string"), path)
    return J.scan_pairs(spark, path)


@pytest.fixture()
def catalog(spark):
    return Catalog(spark, shared_path(spark, "catalog-test"))


def test_extract_profile(spark, source, catalog, rows64):
    ds = JB.extract_job(source, RawConfig(split="test", n=64), catalog)
    assert ds.id == "6ff6609f" and ds.stage == "raw" and ds.n == 64
    m = ds.metrics
    sl, tl = [len(r["en"].split()) for r in rows64], [len(r["fr"].split()) for r in rows64]
    assert (m["src_min_seq_len"], m["src_max_seq_len"], m["src_avg_seq_len"]) == (min(sl), max(sl), round(sum(sl) / 64, 3))
    assert (m["tgt_min_seq_len"], m["tgt_max_seq_len"], m["tgt_avg_seq_len"]) == (min(tl), max(tl), round(sum(tl) / 64, 3))
    assert (m["min_seq_len"], m["max_seq_len"], m["avg_seq_len"]) == (min(sl + tl), max(sl + tl), round(sum(sl + tl) / 128, 3))
    assert ds.series.count() == 64
    assert m["duration"] >= 0 and m["throughput"] >= 0


def test_extract_then_filter_n8(spark, source, catalog):
    raw = JB.extract_job(source, RawConfig(split="test", n=8), catalog)
    assert raw.n == 8 and raw.rows.count() == 8 and raw.stage == "raw"
    filt = JB.filter_job(catalog, raw.id, n=8)
    assert filt.stage == "filtered" and filt.parent_id == raw.id
    assert filt.rows.columns == ["idx", "src", "tgt", "pos"]
    assert filt.rows.count() == filt.n <= 8
    # Length, index, iteration and pandas in the selection order
    assert len(filt) == filt.n and filt.count() == filt.n
    rows = list(filt)
    assert [filt[i] for i in range(len(filt))] == rows
    assert filt.to_pandas().to_dict("records") == rows
    with pytest.raises(IndexError):
        filt[len(filt)]
    with pytest.raises(ValueError):
        filt.to_pandas(max_rows=1)
    reg = catalog.show()
    assert reg.count() == 2 and reg.columns[:4] == ["id", "name", "stage", "split"]
    assert catalog.show(stage="filtered").count() == 1
    assert catalog.show(stage="raw", split="test").count() == 1
    assert catalog.show(split="validation").count() == 0


def test_full_funnel_on_fixture(spark, source, catalog, rows64):
    raw = JB.extract_job(source, RawConfig(split="test", n=64), catalog)
    filt = JB.filter_job(catalog, raw.id, n=50000)
    m = filt.metrics
    reasons = {}
    for r in rows64:
        a, b = len(r["en"].split()), len(r["fr"].split())
        why = "ratio" if max(a, b) / min(a, b) > 2 else "src_short" if a < 4 else "src_long" if a > 64 else "tgt_short" if b < 4 else "tgt_long" if b > 64 else ""
        reasons[why] = reasons.get(why, 0) + 1
    assert m["seen"] == 64 and m["selected"] == reasons[""] and m["filtered_src_short"] == reasons["src_short"] == 1


def test_catalog_set_to_written_batches(spark, source, catalog, tmp_path):
    from corpusprep.config import VocabConfig

    raw = JB.extract_job(source, RawConfig(split="test", n=64), catalog)
    filt = JB.filter_job(catalog, raw.id, n=20)
    model = JB.vocab_job(catalog, filt.id, str(tmp_path / "vocab"), VocabConfig(vocab_size=90))
    JB.batch_job(catalog.get(filt.id).rows, model, str(tmp_path / "batches"), batch_size=8)
    back = spark.read.parquet(str(tmp_path / "batches")).collect()
    assert sum(r["batch_rows"] for r in back) == filt.n
    assert all(len(x) == 64 for r in back for x in r["encoder_input_ids"] + r["labels"])
    with pytest.raises(Exception):
        JB.batch_job(catalog.get(filt.id).rows, model, str(tmp_path / "batches"), batch_size=8)


def test_every_split_is_extracted_from_its_own_rows(spark, catalog, rows64):
    root = shared_path(spark, "hub-splits")
    rows = [(r["en"], r["fr"], "fr-en", "train" if i % 2 else "test") for i, r in enumerate(rows64)]
    J.write_hub(spark.createDataFrame(rows, "en string, fr string, lang string, split string"), root, "wmt14")
    take = lambda split: J.read_hub(spark, root, "wmt14", lang="fr-en", split=split)
    done = JB.run_notebook(take, catalog, ("train", "test"), n=50)
    assert [(d.stage, d.split, d.metrics.get("n")) for d in done[:2]] == [("raw", "train", 32), ("raw", "test", 32)]
    assert {d.split for d in done[2:]} == {"train", "test"}
    texts = [{r["src"] for r in d.rows.collect()} for d in done[:2]]
    assert texts[0] == {r[0] for r in rows if r[3] == "train"} and texts[1] == {r[0] for r in rows if r[3] == "test"}
    with pytest.raises(ValueError, match="split"):
        JB.run_notebook(take, catalog, ("validation",))


def test_repo_scenarios(spark, source, catalog):
    raw = JB.extract_job(source, RawConfig(split="test", n=16), catalog)
    with pytest.raises(FileExistsError):
        catalog.add(raw)  # duplicate refused
    again = catalog.get(raw.id)
    assert sorted(map(tuple, again.rows.collect())) == sorted(map(tuple, raw.rows.collect()))
    with pytest.raises(KeyError):
        catalog.get("00000000")
    assert catalog.exists(raw.id)
    assert catalog.audit().count() == 0
    # absent rows -> FileNotFoundError on get, corruption on exists, found by the audit
    delete_path(spark, catalog.rows_path(raw.id))
    with pytest.raises(FileNotFoundError):
        catalog.get(raw.id)
    with pytest.raises(DataCorruptionError):
        catalog.exists(raw.id)
    assert [r.problem for r in catalog.audit().collect()] == ["manifest_without_rows"]
    assert catalog.remove(raw.id) is True
    assert catalog.remove(raw.id) is False  # idempotent
    assert not catalog.exists(raw.id)
    assert catalog.show().count() == 0


def test_empty_registry_has_schema(spark, catalog):
    reg = catalog.show(stage="raw")
    assert reg.count() == 0 and "stage" in reg.columns


def test_missing_language_key(spark):
    df = spark.createDataFrame([("a",)], "de string")
    with pytest.raises(KeyError, match="no column for language"):
        J.flatten_translation(df)


def test_scan_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        J.scan_pairs(spark, "/nonexistent/path/x.jsonl")


def test_hub_unknown_dataset(spark):
    root = shared_path(spark, "hub-test")
    df = spark.createDataFrame([(1, "a b", "c d", "fr-en", "train")], "row_key long, en string, fr string, lang string, split string")
    J.write_hub(df, root, "wmt14")
    with pytest.raises(ValueError):
        J.read_hub(spark, root, "wmt15")
    with pytest.raises(ValueError):
        J.read_hub(spark, root, "wmt14", lang="de-en")
    with pytest.raises(ValueError):
        J.read_hub(spark, root, "wmt14", lang="fr-en", split="dev")
    one = J.read_hub(spark, root, "wmt14", lang="fr-en", split="train")
    assert "PartitionFilters: [isnotnull(lang" in one._jdf.queryExecution().executedPlan().toString()
    got = one.collect()
    assert [(r.src, r.tgt) for r in got] == [("a b", "c d")]


def test_export_ascii_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("é 😀 \"q\" \\",)], "s string")
    J.export_jsonl(df, str(tmp_path / "x"), ensure_ascii=True)
    raw = "".join(open(p).read() for p in (tmp_path / "x").glob("*.json"))
    assert "é" not in raw and "\\u" in raw
    assert spark.read.schema("s string").json(str(tmp_path / "x")).first().s == "é 😀 \"q\" \\"
    with pytest.raises(Exception):
        J.write_jsonl_exclusive(df, str(tmp_path / "x"))


def test_concurrent_adds_one_wins(spark, source, catalog):
    """Six writers of one id: one dataset, five refusals, nothing left behind."""
    from concurrent.futures import ThreadPoolExecutor

    from corpusprep.plans.catalog import Catalog

    raw = JB.extract_job(source, RawConfig(split="test", n=64), catalog)
    ds = catalog.get(raw.id)
    other = Catalog(spark, shared_path(spark, "claimed"))

    def add(_):
        try:
            other.add(ds)
            return "added"
        except FileExistsError:
            return "refused"

    with ThreadPoolExecutor(6) as pool:
        assert sorted(pool.map(add, range(6))) == ["added"] + ["refused"] * 5
    assert other.get(raw.id).count() == 64 and other.audit().collect() == []
    assert other.remove(raw.id) and not other.remove(raw.id)
    other.add(ds)
    assert other.exists(raw.id)


def test_claims_of_lost_writers(spark, source, catalog):
    """A writer that died behind its claim blocks the id until it is removed, and the audit names it."""
    from corpusprep.plans.catalog import Catalog
    from corpusprep.session import create_once

    raw = JB.extract_job(source, RawConfig(split="test", n=64), catalog)
    other = Catalog(spark, shared_path(spark, "claims"))
    create_once(spark, other.claim_path(raw.id), raw.id)
    with pytest.raises(FileExistsError):
        other.add(catalog.get(raw.id))
    assert [tuple(r) for r in other.audit().collect()] == [(raw.id, "claim_without_rows")] and not other.exists(raw.id)
    assert other.remove(raw.id)
    other.add(catalog.get(raw.id))
    assert other.audit().collect() == []


def test_stored_series(spark, tmp_path):
    from corpusprep.operators.profile import SeriesStore

    store = SeriesStore(spark, str(tmp_path / "series"))
    assert store.info().collect() == [] and store.get("a") is None and not store.remove("a")
    rows = spark.createDataFrame([(1, "x"), (2, None)], "id long, t string")
    store.add("a", rows).add("b / c=1 é", rows.where("id = 1"))
    files = lambda key: sorted(p.name for p in (tmp_path / "series").glob(f"key={key}*/*.parquet"))
    before = files("a")
    store.add("b / c=1 é", rows.union(rows))
    assert files("a") == before  # only its own partition is written
    assert {tuple(r) for r in store.info().collect()} == {("a", 2), ("b / c=1 é", 4)}
    got = store.get("a", "id long, t string")
    assert sorted(map(tuple, got.collect())) == [(1, "x"), (2, None)]
    assert "PartitionFilters: [isnotnull(key" in got._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in store.info()._jdf.queryExecution().executedPlan().toString()
    assert store.remove("b / c=1 é") and not store.remove("b / c=1 é") and store.get("b / c=1 é") is None
    assert [tuple(r) for r in SeriesStore(spark, str(tmp_path / "series")).info().collect()] == [("a", 2)]
    with pytest.raises(ValueError):
        store.add("", rows)
