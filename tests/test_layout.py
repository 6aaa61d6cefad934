"""Bucketing, ranking, sampling and collation against direct Python restatements."""
import hashlib
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.functions import arrays as A
from corpusprep.operators import buckets as BK
from corpusprep.operators import collate as CL
from corpusprep.operators import ranking as R
from corpusprep.operators import sampling as S


def _loop(lengths, keys, batch_size, width, drop_last, seed, epoch=0):
    """The reference sampler's loop, with the in-bucket order given by md5(seed+epoch:key)."""
    buckets = {}
    for k, n in zip(keys, lengths):
        buckets.setdefault(n // width, []).append(k)
    order = {b: sorted(ks, key=lambda k: (hashlib.md5(f"{seed + epoch}:{k}".encode()).hexdigest(), k))
             for b, ks in buckets.items()}
    out = []
    while any(order.values()):
        for b in sorted(order):
            buf = order[b]
            if not buf:
                continue
            batch, order[b] = buf[:batch_size], buf[batch_size:]
            if batch and (len(batch) == batch_size or not drop_last):
                out.append(batch)
    return out


@pytest.mark.parametrize("drop_last", [False, True])
def test_bucket_batches_equal_loop(spark, drop_last):
    rnd = random.Random(7)
    rows = [(k, rnd.choice([1, 2, 3, 20, 21, 40, 70]) + rnd.randint(0, 5)) for k in range(300)]
    df = spark.createDataFrame(rows, "row_key long, length int")
    got = BK.bucket_batches(df, "length", 8, 16, drop_last=drop_last, seed=42).collect()
    batches = {}
    for r in got:
        batches.setdefault(r.batch_index, []).append((r.pos, r.row_key))
    seq = [[k for _, k in sorted(batches[i])] for i in range(len(batches))]
    assert seq == _loop([n for _, n in rows], [k for k, _ in rows], 8, 16, drop_last, 42)
    real = BK.batch_count(df, "length", 8, 16, drop_last).first()
    assert real.n_batches == len(seq)


def test_epochs_reseed(spark):
    df = spark.createDataFrame([(k, k % 40) for k in range(100)], "row_key long, length int")
    got = BK.bucket_batches(df, "length", 4, 16, seed=1, epochs=2).collect()
    for e in (0, 1):
        batches = {}
        for r in got:
            if r.epoch == e:
                batches.setdefault(r.batch_index, []).append((r.pos, r.row_key))
        seq = [[k for _, k in sorted(batches[i])] for i in range(len(batches))]
        assert seq == _loop([k % 40 for k in range(100)], list(range(100)), 4, 16, False, 1, epoch=e)


def test_rank_within_equals_window(spark):
    rows = [(0 if k % 3 else 1, k) for k in range(2000)] + [(None, 5), (None, 6)]  # group 0 holds two thirds of the rows
    df = spark.createDataFrame(rows, "g int, key long").withColumn("h", F.md5(F.col("key").cast("string")))
    got = R.rank_within(df, ["g"], "h", "key", out="rn", partitions=7)
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("h", "key")))
    a = sorted((str(r.g), r.key, r.rn) for r in got.collect())
    b = sorted((str(r.g), r.key, r.rn) for r in exp.collect())
    assert a == b


def test_ranks_of_repeated_rows_and_nulls(spark):
    """Keys repeat with other content, and whole rows repeat: every position is given once, in order, the same each time."""
    rows = [(k % 4 or None, None if k % 7 == 0 else f"t{k % 5}") for k in range(200)]
    df = spark.createDataFrame(rows, "key long, src string").repartition(6)
    told = []
    for parts in (1, 5):
        got = R.rank_within(df.withColumn("h", F.lit("")), [], "h", "key", out="rn", partitions=parts).collect()
        assert sorted(r.rn for r in got) == list(range(1, 201))
        assert sorted(map(str, ((r.key, r.src) for r in got))) == sorted(map(str, rows))
        keys = [r.key for r in sorted(got, key=lambda r: r.rn)]
        assert keys == sorted(keys, key=lambda k: (k is not None, k))
        told.append(sorted((r.rn, str(r.key), str(r.src)) for r in got))
    assert told[0] == told[1]
    assert R.rank_within(df.where("key > 9").withColumn("h", F.lit("")), [], "h", "key").collect() == []


@pytest.mark.parametrize("kind", ["source order", "one key with half the rows", "one row repeated"])
def test_no_task_ranks_more_than_its_share(spark, kind):
    """A million names in 16 partitions: the largest has less than twice the median."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("").alias("skey"), F.col("id").alias("key"), F.col("id").cast("string").alias("src"))
    if kind == "one key with half the rows":
        df = df.withColumn("key", F.when(F.col("key") % 2 == 0, 7).otherwise(F.col("key")))
    if kind == "one row repeated":
        df = spark.range(n).select(F.lit("").alias("skey"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("key"), F.lit("x").alias("src"))
    rows = R.named(df, [], "skey", "key")
    names = rows.groupBy(*R.NAME).agg(F.count(F.lit(1)).alias("_n"))
    assert names.count() == (n // 2 if kind == "one row repeated" else n)
    sizes = sorted(r["count"] for r in names.repartitionByRange(16, *R.NAME).groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    if kind != "source order":
        got = R.positions(rows, partitions=16).agg(F.count("rn").alias("n"), F.max("rn").alias("top"), F.sum("rn").alias("sum")).first()
        assert (got["n"], got["top"], got["sum"]) == (n, n, n * (n + 1) // 2)


def test_a_hundred_thousand_buckets(spark):
    """No literal per bucket: the plan is small, and every batch has its own place."""
    df = spark.range(300_000).select(F.col("id").alias("row_key"), (F.col("id") % 100_000).cast("int").alias("length"))
    got = BK.bucket_batches(df, "length", 2, 1, seed=3)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    told = got.groupBy("batch_index").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("bucket_id").alias("b"), F.min("chunk").alias("c"), F.min("bucket_id").alias("first"))
    sums = told.agg(F.count(F.lit(1)).alias("batches"), F.max("batch_index").alias("last"), F.max("b").alias("b"), F.count_if(F.col("n") == F.lit(2) - F.col("c")).alias("full"),
                    F.count_if(F.col("batch_index") == F.col("c") * 100_000 + F.col("first")).alias("placed")).first()
    assert tuple(sums) == (200_000, 199_999, 1, 200_000, 200_000)
    assert BK.bucket_batches(df, "length", 2, 1, drop_last=True).count() == 200_000


def test_kth_in_order_with_repeated_keys(spark):
    rows = [(k, hashlib.md5(str(k).encode()).hexdigest()) for k in range(500)] + [(7, "0" * 32)] * 5
    df = spark.createDataFrame(rows, "row_key long, skey string")
    ordered = sorted((s, k) for k, s in rows)
    for k in (1, 3, 5, 6, 40, 505):
        cut = S.kth_in_order(df, k)
        assert (cut.skey, cut.key) == ordered[k - 1]
        assert ordered[k - cut.take : k - cut.take + cut.tied] == [ordered[k - 1]] * cut.tied
    assert S.kth_in_order(df, 506) is None


def test_kth_value_of_strings_and_numbers(spark):
    import random

    rng = random.Random(6)
    words = [None, "", "a", "ab", "ab", "é", "\U0001F600"] + ["".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(80)]
    numbers = [None, -(2**62), 2**62] + [rng.randint(-10, 10**6) for _ in range(60)] + [5] * 9
    for kind, values in (("string", words), ("long", numbers)):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
        order = sorted(values, key=lambda v: (v is not None, v))
        for k in (1, 2, 7, 30, len(values)):
            v, rank, n = S.kth_value(df, "v", k)
            assert v == order[k - 1] and n == values.count(v) and order[k - rank] == v and (k == rank or order[k - rank - 1] != v)
        assert S.kth_value(df, "v", len(values) + 1) is None


def test_exactly_n_rows_with_repeated_keys(spark):
    rows = [(k % 5, f"t{k % 7}") for k in range(60)] + [(None, "x")] * 3
    df = spark.createDataFrame(rows, "row_key long, src string").repartition(4)
    for shuffle in (True, False):
        for n in (1, 4, 13, 29, 62, 63, 80):
            got = [tuple(r) for r in S.sample_n(df, n, shuffle=shuffle).select("row_key", "src").collect()]
            assert len(got) == min(n, 63)
            assert all(got.count(r) <= rows.count(r) for r in got)
        again = [sorted(S.sample_n(df, 13, shuffle=shuffle).select("row_key", "src").collect(), key=str) for _ in range(2)]
        assert again[0] == again[1]


def test_source_order_of_many_rows_stays_off_the_driver(spark):
    """A million rows: every step brings range counts only."""
    df = spark.range(1_000_000).select(F.col("id").alias("row_key"), F.lit("x").alias("src"))
    seen, collect = [], type(df).collect

    def counted(self):
        out = collect(self)
        seen.append(len(out))
        return out

    type(df).collect = counted
    try:
        got = S.sample_n(df, 260_000, shuffle=False)
    finally:
        type(df).collect = collect
    assert max(seen) <= 65_536 and sum(seen) < 100_000
    assert got.count() == 260_000 and got.agg(F.max("row_key")).first()[0] == 259_999


def test_sample_n_and_first_n(spark):
    rows = [(k, "a b c d e", "a b c d" if k % 4 else "") for k in range(200)]
    df = spark.createDataFrame(rows, "row_key long, src string, tgt string")
    got = S.sample_n(df, 10, seed=3).select("row_key").collect()
    exp = sorted(range(200), key=lambda k: (hashlib.md5(f"3:{k}".encode()).hexdigest(), k))[:10]
    assert sorted(r.row_key for r in got) == sorted(exp)
    from corpusprep.config import FilterConfig
    from corpusprep.operators.quality import classify

    res = S.first_n_valid(classify(df, FilterConfig()), 20, seed=3)
    order = sorted(range(200), key=lambda k: (hashlib.md5(f"3:{k}".encode()).hexdigest(), k))
    seen, ok = 0, 0
    for k in order:
        seen += 1
        ok += bool(k % 4)
        if ok == 20:
            break
    f = res.funnel.first()
    assert (f.seen, f.selected, f.filtered_empty) == (seen, 20, seen - 20)
    assert res.selected.count() == 20


def test_sample_with_replacement_counts(spark):
    df = spark.createDataFrame([(k,) for k in range(50)], "row_key long")
    got = S.sample_with_replacement(df, 120, seed=5).collect()
    assert len(got) == 120 and all(0 <= r.row_key < 50 for r in got)


def test_collate_golden(spark):
    df = spark.createDataFrame([(1, [5], [5])], "row_key int, src_ids array<int>, tgt_ids array<int>")
    r = CL.collate_rows(df, l_src=6, l_tgt=6, pad_id=0, bos_id=2, eos_id=3).first()
    assert r.encoder_input_ids == [5, 0, 0, 0, 0, 0]
    assert r.decoder_input_ids == [2, 5, 0, 0, 0, 0]
    assert r.labels == [5, 0, 0, 0, 0, 3]
    assert r.decoder_attn_mask == [True, True, False, False, False, False]
    r2 = CL.collate_rows(df, l_src=6, l_tgt=6, pad_id=0, bos_id=2, eos_id=3, eos="after_text").first()
    assert r2.labels == [5, 3, 0, 0, 0, 0]


def test_truncation_and_batch_max(spark):
    df = spark.createDataFrame([(0, [1, 2, 3, 4, 5, 6, 7, 8]), (0, [9])], "b int, ids array<int>")
    assert [r.t for r in df.select(A.pad_truncate("ids", 4, 0).alias("t")).collect()] == [[1, 2, 3, 4], [9, 0, 0, 0]]
    got = CL.pad_to_batch_max(df, "ids", ["b"]).collect()
    assert sorted(len(r.ids) for r in got) == [8, 8]
    x, y = A.next_token_pairs("ids", 3)
    r = df.select(x.alias("x"), y.alias("y")).first()
    assert (r.x, r.y) == ([1, 2, 3], [2, 3, 4])


def test_extension_rules_and_transform(spark):
    """K: stages compose with DataFrame.transform; extra reject rules append to the fixed order."""
    from corpusprep.config import FilterConfig
    from corpusprep.operators.quality import classify, filter_valid

    df = spark.createDataFrame(
        [(1, "one two three four", "un deux trois quatre"), (2, "one 2 three four", "un deux trois quatre"),
         (3, "a", "b c d e f")],
        "row_key long, src string, tgt string",
    )
    rules = [("has_digit", F.col("src").rlike("[0-9]"))]
    out = df.transform(lambda d: classify(d, FilterConfig(), extra_rules=rules)).orderBy("row_key").collect()
    assert [r.reason for r in out] == [None, "has_digit", "ratio"]
    assert df.transform(lambda d: classify(d, FilterConfig(), extra_rules=rules)).transform(filter_valid).count() == 1
