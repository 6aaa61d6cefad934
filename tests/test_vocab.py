"""BPE learning equals the trainer the reference delegates to (differential), plus encode/decode."""
import json

import pytest

from corpusprep.config import VocabConfig
from corpusprep.operators import vocab as V

tokenizers = pytest.importorskip("tokenizers")
SPECIALS = ["<PAD>", "<UNK>", "<BOS>", "<EOS>", "<MASK>"]


def _library(texts, vs, mf, specials=SPECIALS):
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import Whitespace
    from tokenizers.trainers import BpeTrainer

    tok = Tokenizer(BPE(unk_token="<UNK>"))
    tok.pre_tokenizer = Whitespace()
    tok.train_from_iterator(texts, trainer=BpeTrainer(vocab_size=vs, min_frequency=mf, special_tokens=list(specials),
                                                      show_progress=False))
    merges = json.loads(tok.to_str())["model"]["merges"]
    return tok, [m if isinstance(m, list) else m.split(" ") for m in merges]


@pytest.fixture(scope="module")
def texts(rows64):
    out = []
    for r in rows64:
        out += [r["en"].strip(), r["fr"].strip()]
    return out


@pytest.fixture(scope="module")
def model600(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return V.learn_bpe(df, VocabConfig(vocab_size=600, min_frequency=2))


@pytest.mark.parametrize("vs,mf", [(120, 2), (30000, 5)])
def test_learn_equals_library(spark, texts, vs, mf):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    m = V.learn_bpe(df, VocabConfig(vocab_size=vs, min_frequency=mf))
    tok, lib_merges = _library(texts, vs, mf)
    assert len(m.merges) > 20
    assert {t: i for i, t in enumerate(m.tokens)} == tok.get_vocab()
    assert [[m.tokens[a], m.tokens[b]] for a, b, _ in m.merges] == lib_merges


ODD_WORDS = ["aaaaaaa", "aaa", "abababab", "abcabcabc", "bbbbab", "the", "then", "there", "thethe", "zz", "zzzz", "mère", "漢字漢", "a", "=====", "!!", "x" * 60]


@pytest.mark.parametrize("segments,first,margin", [(100_000, 64, 3), (40, 4, 3), (5, 1, 1), (300, 16, 1)])
def test_rounds_of_any_size_learn_the_same(spark, monkeypatch, segments, first, margin):
    """Runs of one symbol, tokens that come about twice, ties; neighbourhoods that end early, rounds of a single pair."""
    import random

    rng = random.Random(segments)
    monkeypatch.setattr(V, "FIRST_PAIRS", first)
    monkeypatch.setattr(V, "MARGIN", margin)
    words = ODD_WORDS[: 17 if segments > 100 else 9] + ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(150)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(120)]
    most = {40: 120, 5: 50}.get(segments, 2000)
    m = V.learn_bpe(spark.createDataFrame([(t,) for t in lines], "text string").repartition(5), VocabConfig(most, 2), max_segments=segments)
    tok, lib_merges = _library(lines, most, 2)
    assert {t: i for i, t in enumerate(m.tokens)} == tok.get_vocab()
    assert [[m.tokens[a], m.tokens[b]] for a, b, _ in m.merges] == lib_merges
    assert len(m.merges) > len(m.tokens) - 5 - len({c for t in lines for c in t}) or most < 200  # some token was made twice


def test_apply_merges_in_their_order():
    """A merge sees only what is there at its turn: pairs that come about later wait for a later merge of theirs."""
    rank = {(1, 2): [0], (3, 4): [1, 3], (5, 4): [2]}
    new = [9, 1, 3, 8]
    assert V.apply_merges([3, 4, 2], rank, new) == [1, 2]  # (1, 2) was merged before 1 came about
    assert V.apply_merges([5, 4, 4], rank, new) == [8]  # 5 4 -> 3, then the second merge of (3, 4)
    assert V.apply_merges([1, 2, 1, 2, 1], rank, new) == [9, 9, 1]


def test_learning_goes_on_after_a_lost_driver(spark, texts, tmp_path, monkeypatch):
    cfg = VocabConfig(600, 2)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    monkeypatch.setattr(V, "FIRST_PAIRS", 4)
    monkeypatch.setattr(V, "MOST_PAIRS", 8)
    whole = V.learn_bpe(df, cfg)
    path = str(tmp_path / "state")
    seen = []

    def lost(rounds, merges, tokens, told):
        seen.append(merges)
        if rounds == 2:
            raise KeyboardInterrupt

    for _ in range(2):
        with pytest.raises(KeyboardInterrupt):
            V.learn_bpe(df, cfg, state_path=path, log=lost)
    assert seen == sorted(seen) and len(set(seen)) == 4  # no round is repeated
    # a round that was written and not committed is written anew
    import shutil

    state = V._resume(spark, path, cfg)
    shutil.copytree(state.table("pairs"), f"{path}/pairs-{state.version + 1:06d}")
    refused = spark.createDataFrame([("not read again",)], "text string")
    done = V.learn_bpe(refused, cfg, state_path=path)
    assert (done.tokens, done.merges) == (whole.tokens, whole.merges)
    again = V.learn_bpe(refused, cfg, state_path=path)
    assert (again.tokens, again.merges) == (whole.tokens, whole.merges)
    with pytest.raises(ValueError, match="other settings"):
        V.learn_bpe(df, VocabConfig(601, 2), state_path=path)


def test_late_rounds_touch_few_words(spark, texts, tmp_path, monkeypatch):
    """Words of one symbol leave the table, and only changed words change pair counts."""
    sizes = []
    path = str(tmp_path / "state")

    def log(rounds, merges, tokens, told):
        state = V._resume(spark, path, VocabConfig(2000, 2))
        if not state.done:
            step = spark.read.schema(V.STEP_SCHEMA).parquet(state.table("step"))
            sizes.append(step.where("kind = 0").count())

    monkeypatch.setattr(V, "FIRST_PAIRS", 8)
    monkeypatch.setattr(V, "MOST_PAIRS", 32)
    V.learn_bpe(spark.createDataFrame([(t,) for t in texts], "text string"), VocabConfig(2000, 2), state_path=path, log=log)
    assert len(sizes) > 2 and sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0] // 2


def test_pair_counts(spark):
    df = spark.createDataFrame([("aaa", 2), ("a漢🎉", 3), ("z", 9), ("é漢", 1)], "word string, freq long")
    assert {tuple(r) for r in V.pair_counts(df).collect()} == {("a", "a", 4), ("a", "漢", 3), ("漢", "🎉", 3), ("é", "漢", 1)}


def test_vocab_job_restarts(spark, rows64, tmp_path, monkeypatch):
    """Killed after two rounds and again while saving, the job ends with the model of an undisturbed run."""
    from corpusprep.config import RawConfig
    from corpusprep.plans import jobs as JB
    from corpusprep.plans.catalog import Catalog

    monkeypatch.setattr(V, "FIRST_PAIRS", 4)
    monkeypatch.setattr(V, "MOST_PAIRS", 16)
    cat = Catalog(spark, str(tmp_path / "catalog"))
    source = spark.createDataFrame([(i, r["en"], r["fr"]) for i, r in enumerate(rows64)], "row_key long, src string, tgt string")
    ds = JB.filter_job(cat, JB.extract_job(source, RawConfig(split="train", n=64), cat).id, n=64).id
    cfg = VocabConfig(150, 2)
    whole = JB.vocab_job(cat, ds, str(tmp_path / "whole"), cfg)
    assert not (tmp_path / "whole.learning").exists()

    def lost(rounds, *_):
        if rounds == 2:
            raise KeyboardInterrupt

    out = str(tmp_path / "vocab")
    with pytest.raises(KeyboardInterrupt):
        JB.vocab_job(cat, ds, out, cfg, log=lost)
    assert not V.BpeModel.saved(spark, out) and (tmp_path / "vocab.learning").exists()
    whole.vocab_df(spark).limit(3).write.parquet(f"{out}/vocab")  # a save that was cut short
    done = JB.vocab_job(cat, ds, out, cfg)
    assert (done.tokens, done.merges) == (whole.tokens, whole.merges)
    read = JB.vocab_job(cat, ds, out, cfg)
    assert (read.tokens, read.merges) == (whole.tokens, whole.merges) and not (tmp_path / "vocab.learning").exists()


def test_one_writer_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from corpusprep.session import create_once

    def write(i):
        try:
            create_once(spark, str(tmp_path / "claim"), f"writer {i}")
            return i
        except FileExistsError:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(write, range(24)) if i is not None]
    assert len(won) == 1 and (tmp_path / "claim").read_text() == f"writer {won[0]}"
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["claim"]


def test_one_character_special_tokens(spark, texts):
    """They keep their place among the special tokens, and still take part in merges."""
    special = ("<UNK>", "e", "<EOS>", "t")
    m = V.learn_bpe(spark.createDataFrame([(t,) for t in texts], "text string"), VocabConfig(120, 2, special))
    tok, lib_merges = _library(texts, 120, 2, special)
    assert {t: i for i, t in enumerate(m.tokens)} == tok.get_vocab()
    assert [[m.tokens[a], m.tokens[b]] for a, b, _ in m.merges] == lib_merges


def test_vocab600_and_encode(spark, texts, model600):
    tok, lib_merges = _library(texts, 600, 2)
    assert {t: i for i, t in enumerate(model600.tokens)} == tok.get_vocab()
    assert [[model600.tokens[a], model600.tokens[b]] for a, b, _ in model600.merges] == lib_merges
    samples = ["hello world", "bonjour la maison", "<BOS> the house 漢字 <EOS>", "x.<BOS>y", texts[0], texts[1], "", "le" * 3000]
    got = V.encode(spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "k int, text string"), model600, "text")
    got = {r.k: r.ids for r in got.collect()}
    for i, s in enumerate(samples):
        assert got[i] == tok.encode(s).ids, s


def test_ids_of_a_table_equal_the_library(spark):
    """Every text of the given pairs, with the vocabulary learnt from them to its end: ids by value."""
    from corpusprep.plans.queries import _clean
    from samples import SF001
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import Whitespace

    pairs = _clean(spark, SF001).select("row_key", "src", "tgt")
    texts = V.corpus_texts(pairs, key="row_key")
    m = V.learn_bpe(texts, VocabConfig())
    merges = [(m.tokens[a], m.tokens[b]) for a, b, _ in m.merges]
    lib = Tokenizer(BPE(vocab=m.token_to_id, merges=merges, unk_token="<UNK>"))
    lib.pre_tokenizer = Whitespace()
    got = V.encode(texts, m, "text").collect()
    assert len(got) > 300 and sum(len(r["ids"]) for r in got) > 3000
    assert all(r["ids"] == lib.encode(r["text"]).ids for r in got)


def test_models_of_equal_size_do_not_mix(spark):
    """Workers outlive models: what one has cached must not be used by another."""
    df = spark.createDataFrame([("ab ba",)], "text string")
    one = V.BpeModel(["<UNK>", "a", "b", "ab"], [(1, 2, 3)], ("<UNK>",), "<UNK>")
    two = V.BpeModel(["<UNK>", "a", "b", "ba"], [(2, 1, 3)], ("<UNK>",), "<UNK>")
    for _ in range(2):
        assert V.encode(df, one, "text").first().ids == [3, 2, 1]
        assert V.encode(df, two, "text").first().ids == [1, 2, 3]


def test_decode_drops_specials_and_keeps_rows(spark, model600):
    df = spark.createDataFrame([(1, "<BOS> la maison <EOS>"), (1, "la maison"), (2, ""), (3, None)], "k int, text string")
    dec = V.decode(V.encode(df, model600, "text"), model600, "ids").select("k", "text", "decoded")
    assert "Exchange" not in dec._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["k"], (r["decoded"] or "").replace(" ", "")) for r in dec.collect())
    assert got == [(1, "lamaison"), (1, "lamaison"), (2, ""), (3, "")]


def test_decode_any_ids(spark, model600):
    """Unknown and null ids are left out; rows, empty and null arrays stay; several columns at once."""
    special = set(model600.special_tokens)
    rows = [(0, [5, 6, 7, 0, 1, 2], [599, 600, -1, 5]), (1, [], None), (2, None, [None, 8]), (3, [4] * 5, list(range(600)))]
    df = spark.createDataFrame(rows, "k int, a array<int>, b array<int>").repartition(2)
    told = lambda ids: " ".join(model600.tokens[i] for i in ids or [] if i is not None and 0 <= i < len(model600.tokens) and model600.tokens[i] not in special)
    got = {r.k: (r.x, r.y) for r in V.decode(df, model600, ["a", "b"], ["x", "y"]).collect()}
    assert got == {k: (told(a), told(b)) for k, a, b in rows}


def test_save_load_roundtrip(spark, model600, tmp_path):
    path = str(tmp_path / "vocab")
    model600.save(spark, path)
    back = V.BpeModel.load(spark, path)
    assert back.tokens == model600.tokens and back.merges == model600.merges
    with pytest.raises(Exception):
        model600.save(spark, path)  # create-only


def test_empty_texts_give_specials_only(spark):
    df = spark.createDataFrame([("",), ("",)], "text string")
    m = V.learn_bpe(df, VocabConfig(vocab_size=100, min_frequency=2))
    assert m.tokens == SPECIALS and m.merges == []


def test_argument_checks():
    with pytest.raises(ValueError):
        VocabConfig(vocab_size=0).validate()
    with pytest.raises(ValueError):
        VocabConfig(unk_token="<X>").validate()
    with pytest.raises(ValueError):
        VocabConfig(special_tokens=()).validate()
    with pytest.raises(TypeError):
        VocabConfig(min_frequency="2").validate()


def test_corpus_texts_requires_columns(spark):
    df = spark.createDataFrame([("a", "b")], "en string, fr string")
    with pytest.raises(KeyError):
        V.corpus_texts(df)
    out = V.corpus_texts(spark.createDataFrame([("a", None)], "src string, tgt string")).collect()
    assert [(r.side, r.text) for r in out] == [(0, "a"), (1, "")]


@pytest.mark.parametrize("at_once", [0, 64])
def test_merges_of_many_words_at_once(monkeypatch, at_once):
    """All words of a batch together or word by word: the same words and the same changes of pair counts, by definition."""
    import random
    from collections import Counter

    import pyarrow as pa

    monkeypatch.setattr(V, "MERGES_AT_ONCE", at_once)
    rng = random.Random(7)
    words = [[rng.choice((-1, 2, 3)) for _ in range(rng.randint(0, 9))] for _ in range(400)] + [[2] * n for n in range(1, 9)]
    freq = [rng.randint(1, 5) for _ in words]
    merges = [(2, 2, 9), (9, 9, 10), (-1, 3, 11), (11, 2, 9), (9, 3, 12)]
    want = []
    for w in words:
        for l, r, n in merges:
            w = V._merged(w, (l, r), n)
        want.append(w)
    change = Counter()
    for old, new, f in zip(words, want, freq, strict=True):
        change.update({p: 0 for p in zip(old, old[1:])})
        for s, sign in ((old, -1), (new, 1)):
            for p in zip(s, s[1:]):
                change[p] += sign * f
    batch = pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.int32())), pa.array(freq, pa.int64())], names=["sym", "freq"])
    rows = [r for out in V._step_fn(merges, False)([batch.slice(0, 100), batch.slice(100)]) for r in out.to_pylist()]
    key = lambda w: (tuple(w[0]), w[1])
    assert sorted(key((r["sym"], r["freq"])) for r in rows if r["kind"] == 0) == sorted(key(w) for w in zip(want, freq) if len(w[0]) > 1)
    got = Counter()
    for r in rows:
        if r["kind"] == 1:
            got[(r["l"], r["r"])] += r["cnt"]
    assert {p: n for p, n in got.items() if n} == {p: n for p, n in change.items() if n}


def test_rounds_are_as_wide_as_the_words_ask_for(spark, texts, tmp_path, monkeypatch):
    """Not as wide as the session's shuffles; and a round asks for as many pairs as neighbourhoods leave room for."""
    monkeypatch.setattr(V, "FIRST_PAIRS", 8)
    path, files, setting = str(tmp_path / "state"), [], spark.conf.get("spark.sql.shuffle.partitions")

    def log(rounds, *_):
        state = V._resume(spark, path, VocabConfig(2000, 2))
        if not state.done:
            files.append(len([f for f in (tmp_path / "state" / state.table("pairs").rsplit("/", 1)[1]).iterdir() if f.name.startswith("part-")]))

    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        V.learn_bpe(spark.createDataFrame([(t,) for t in texts], "text string"), VocabConfig(2000, 2), state_path=path, log=log)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", setting)
    assert files and max(files) <= spark.sparkContext.defaultParallelism
    assert V._next_wanted(4, 30_000, 100_000) == 10 and V._next_wanted(4, 0, 100_000) == 16 and V._next_wanted(4, 90_000, 100_000) == 4
