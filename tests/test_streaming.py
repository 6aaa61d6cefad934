"""Streaming ingest: drains arriving files; a restart from the checkpoint loses and repeats nothing."""
import hashlib
import json
import random
import tracemalloc
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from corpusprep.config import FilterConfig
from corpusprep.session import delete_path, path_exists, shared_path
from corpusprep.streaming.ingest import committed_batches, drain_shuffle, ingested_rows, shuffle_stream, small_batches, stream_ingest, stream_pairs, stream_take


def _write(spark, path, rows):
    df = spark.createDataFrame(rows, "row_key long, en string, fr string")
    df.select("row_key", F.struct("en", "fr").alias("translation")).coalesce(1).write.mode("append").json(path)


def _rows(lo, hi):
    return [(k, "one two three four five", "un deux trois quatre cinq" if k % 3 else "x") for k in range(lo, hi)]


def test_restart_no_loss_no_duplicates(spark):
    src, out, ck = (shared_path(spark, n) for n in ("s_in", "s_out", "s_ck"))
    _write(spark, src, _rows(0, 30))
    _write(spark, src, _rows(30, 60))
    ing = stream_ingest(spark, src, out, ck, FilterConfig(), max_files_per_trigger=1)
    ing.await_done()
    assert sum(p["numInputRows"] for p in ing.query.recentProgress) == 60  # every row is read once
    _write(spark, src, _rows(60, 90))
    ing2 = stream_ingest(spark, src, out, ck, FilterConfig(), max_files_per_trigger=1)
    ing2.await_done()
    keys = [r.row_key for r in ing2.rows().select("row_key").collect()]
    assert sorted(map(int, keys)) == list(range(90)) and ing2.committed() == [0, 1, 2]
    tot = ing2.latest_totals().first()
    assert tot.seen == 90 and tot.ok == 60 and tot.src_short == 0
    assert tot.ratio + tot.tgt_short == 30 and (tot.src_min_seq_len, tot.src_max_seq_len, tot.src_sum) == (5, 5, 450)


def test_crash_between_rows_and_commit(spark):
    """Rows written without their log entry are not seen, and are written again; a committed batch is not repeated."""
    src, out, ck = (shared_path(spark, n) for n in ("c_in", "c_out", "c_ck"))
    for lo in (0, 30, 60):
        _write(spark, src, _rows(lo, lo + 30))

    def crash(batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        stream_ingest(spark, src, out, ck, between=crash).await_done()
    assert committed_batches(spark, out) == [0] and ingested_rows(spark, out).count() == 30
    assert path_exists(spark, f"{out}/rows/batch=1")
    ing = stream_ingest(spark, src, out, ck)
    ing.await_done()
    assert sorted(int(r.row_key) for r in ing.rows().select("row_key").collect()) == list(range(90))
    assert ing.latest_totals().first().seen == 90
    # the log was written, the engine's own commit was lost: the batch comes again and is skipped
    assert delete_path(spark, f"{ck}/commits/2")
    again = stream_ingest(spark, src, out, ck, between=lambda b: (_ for _ in ()).throw(RuntimeError("written twice")))
    again.await_done()
    assert again.rows().count() == 90 and again.latest_totals().first().seen == 90
    with pytest.raises(FileNotFoundError):
        ingested_rows(spark, shared_path(spark, "nothing"))


def _shuffled(spark, src, out, ck, size, shards=3):
    stream = shuffle_stream(stream_pairs(spark, src), size, seed=5, shards=shards)
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    left = spark.read.schema(stream.schema).parquet(out)
    return sorted(map(tuple, left.collect()), key=str), sorted(map(tuple, drain_shuffle(spark, ck, stream.schema).collect()), key=str)


def test_buffered_shuffle(spark):
    """Every row comes out once; a bounded number waits; a restart leaves the same rows in the same places."""
    src = shared_path(spark, "b_in")
    for lo in (0, 40, 80):
        _write(spark, src, [*_rows(lo, lo + 40), (None, 'quote " \\ 漢🎉', None)])
    whole = _shuffled(spark, src, shared_path(spark, "b_out"), shared_path(spark, "b_ck"), 30)
    assert len(whole[1]) == 30 and len(whole[0]) + len(whole[1]) == 123
    both = sorted(whole[0] + whole[1], key=str)
    assert both == sorted([(str(k), e, f) for k, e, f in _rows(0, 120)] + [(None, 'quote " \\ 漢🎉', None)] * 3, key=str)
    # the same files in two runs of the query
    first, out, ck = (shared_path(spark, n) for n in ("b2_in", "b2_out", "b2_ck"))
    _write(spark, first, [*_rows(0, 40), (None, 'quote " \\ 漢🎉', None)])
    _shuffled(spark, first, out, ck, 30)
    for lo in (40, 80):
        _write(spark, first, [*_rows(lo, lo + 40), (None, 'quote " \\ 漢🎉', None)])
    assert _shuffled(spark, first, out, ck, 30) == whole
    with pytest.raises(ValueError):
        shuffle_stream(stream_pairs(spark, src), 0)


def test_stream_take(spark):
    src, out, ck = (shared_path(spark, n) for n in ("t_in", "t_out", "t_ck"))
    _write(spark, src, _rows(0, 30))
    _write(spark, src, _rows(30, 60))
    q = (stream_take(stream_pairs(spark, src), 40).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 40


def test_stream_input_grows_in_files_not_in_file_size(spark, monkeypatch):
    """Files hold a bounded part of the table, triggers a bounded number of files."""
    from corpusprep.plans import queries as Q

    sf = "/root/testdata/sf0.01"
    assert Q._stream_input(spark, sf)[1] == 1
    monkeypatch.setattr(Q, "STREAM_FILE", 1 << 16)
    monkeypatch.setattr(Q, "STREAM_FILES", 5)
    path, each = Q._stream_input(spark, sf)
    files = len([f for f in spark.read.json(path).inputFiles()])
    assert files == 22 and each == 5
    ing = Q._ingested(spark, sf)
    assert ing.committed() == [0, 1, 2, 3, 4] and ing.latest_totals().first().seen == ing.rows().count() == spark.read.json(path).count()


def test_buffered_shuffle_takes_bounded_batches(spark, monkeypatch):
    """A task holds a shard's rows of one micro-batch; more input is more batches, not larger ones."""
    from corpusprep.plans import queries as Q
    from corpusprep.session import list_files

    made = {}
    monkeypatch.setattr(Q, "shared_path", lambda spark, name: made.setdefault(name, shared_path(spark, name)))
    monkeypatch.setattr(Q, "STREAM_FILE", 1 << 17)
    monkeypatch.setattr(Q, "STREAM_FILES", 2)
    sf = "/root/testdata/sf0.01"
    out = Q.q_buffered_shuffle(spark, sf)
    assert len(list_files(spark, made["shuffled_ck"] + "/commits")) == 6  # 11 files
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, Q.documents_pairs(spark, sf).select("row_key", "src", "tgt").collect()))


def test_buffered_shuffle_sorts_in_bounded_memory(spark, monkeypatch):
    """A task's memory does not grow with its rows of a micro-batch; they leave in the order of a plain sort."""
    taken, whole = [], GroupedData.applyInPandasWithState
    monkeypatch.setattr(GroupedData, "applyInPandasWithState", lambda self, f, *a: taken.append(f) or whole(self, f, *a))
    src = shared_path(spark, "m_in")
    _write(spark, src, _rows(0, 3))
    shuffle_stream(stream_pairs(spark, src), 40, seed=5, shards=4)

    def pushed(n):
        keys = [str(k) for k in range(n)]
        random.Random(1).shuffle(keys)
        frames = (pd.DataFrame({"row_key": keys[lo:lo + 100], "src": [f"{k:>9}" * 900 for k in keys[lo:lo + 100]], "tgt": None}) for lo in range(0, n, 100))
        state, left = SimpleNamespace(exists=False), []
        state.update = left.append
        tracemalloc.start()
        out = [json.loads(r)[0] for f in taken[0](("2",), frames, state) for r in f["row"]]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        held, gone = [], []
        for seen, k in enumerate(sorted(keys)):
            if len(held) < 10:
                held.append(k)
            else:
                i = int(hashlib.md5(f"5:2:{seen}".encode()).hexdigest()[:15], 16) % 10
                gone.append(held[i])
                held[i] = k
        assert out == gone and left[0][0] == n and [json.loads(r)[0] for r in left[0][1]] == held
        return peak

    assert pushed(16000) < 1.5 * pushed(4000)


def test_queries_started_with_small_batches_keep_them(spark):
    src, out, ck = (shared_path(spark, n) for n in ("a_in", "a_out", "a_ck"))
    _write(spark, src, _rows(0, 1200))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(key, frames, state):
        yield pd.DataFrame({"n": [len(f) for f in frames]})

    one = stream_pairs(spark, src).withColumn("k", F.lit("a")).groupBy("k").applyInPandasWithState(sizes, "n long", "n long", "append", "NoTimeout")
    with small_batches(spark):
        q = one.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
    assert spark.conf.get(name) == before
    q.awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [200, 500, 500]
