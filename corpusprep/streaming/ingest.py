"""Structured Streaming: incremental pair ingestion.

Arriving JSON Lines files are read with an explicit schema (``maxFilesPerTrigger`` bounds each micro-batch),
flattened (A4), measured and classified (C1, D1). One query does all: each micro-batch is computed once, its rows are
written to a folder of its own while the same job observes its counts, and a log entry with these counts commits
both. A batch that is repeated after a crash overwrites its folder if it was not committed and is skipped if it was, so
rows and totals always agree: no loss, no duplicates, whatever is lost between the writes.

The buffered shuffle is the stream form of the seeded sample: rows pass through buffers of a fixed size, held as keyed
state; every new row pushes out a row drawn by a seeded hash. What is still in the buffers at the end is read from
the state store.
"""
from __future__ import annotations

import hashlib
import heapq
import json
import pickle
import sys
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from corpusprep.config import FilterConfig
from corpusprep.operators import quality as Q
from corpusprep.session import create_once, fs_for, path_exists
from corpusprep.sources.jsonl import flatten_translation, pair_schema


def stream_pairs(spark: SparkSession, in_dir: str, lang_src: str = "en", lang_tgt: str = "fr",
                 key_field: str = "row_key", max_files_per_trigger: int = 1,
                 key_type: T.DataType = T.StringType()) -> DataFrame:
    """An unbounded frame of ``row_key, src, tgt`` over JSON Lines files arriving in ``in_dir``."""
    schema = pair_schema(lang_src, lang_tgt).add(key_field, key_type)
    raw = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("mode", "FAILFAST")
        .json(in_dir)
    )
    return flatten_translation(raw, lang_src, lang_tgt, keep=[key_field])


def stream_take(stream: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a stream (append mode). The limit belongs to one query and its
    checkpoint; a different query starts counting again."""
    return stream.limit(n)


RUN_BYTES = 16 << 20  # of rows that a task of the buffered shuffle sorts in memory at a time
OUT_ROWS = 500  # that it gives back at a time
ARROW_ROWS = 500  # of an Arrow batch: Spark's worker holds up to 57 batches of a group that were already read (cells of a tee)


def shuffle_stream(stream: DataFrame, buffer_size: int, seed: int = 42, key: str = "row_key", shards: int = 8) -> DataFrame:
    """B1 on a stream: rows leave in the order of a bounded-buffer shuffle (append mode; state in the checkpoint).

    ``buffer_size`` rows are held in all, dealt over ``shards`` by a hash of the key, so no task holds more than its
    share. Every row of a shard takes the place of the buffered row that the hash of (seed, shard, number of rows so far)
    names. Within a micro-batch, rows go by key and content: a restarted query gives the same rows in the
    same places. ``drain_shuffle`` gives what is left in the buffers.

    A task's Python holds its buffer, ``RUN_BYTES`` of rows and Spark's Arrow batches (start the query in ``small_batches``), however
    large a micro-batch is: a streaming frame can't be sorted by Spark, so the rest of its rows lies in sorted runs in a
    temp file of the task.
    """
    if buffer_size < 1 or shards < 1:
        raise ValueError("buffer_size and shards must be 1 or more")
    columns, each, run_bytes, out_rows = stream.columns, -(-buffer_size // shards), RUN_BYTES, OUT_ROWS
    place = columns.index(key)

    def keyed_rows(frames):
        for f in frames:
            for r in f[columns].to_numpy(object).tolist():
                yield str(r[place]), json.dumps([None if x is None or x != x else x for x in r], ensure_ascii=False, default=lambda v: v.item())

    def read_run(file, at, end):
        while at < end:
            file.seek(at)
            row = pickle.load(file)
            at = file.tell()
            yield row

    def in_order(rows):
        with tempfile.TemporaryFile() as file:
            runs, run, size = [], [], 0
            for row in rows:
                run.append(row)
                size += sys.getsizeof(row) + sys.getsizeof(row[0]) + sys.getsizeof(row[1])
                if size >= run_bytes:
                    at = file.tell()
                    for r in sorted(run):
                        pickle.dump(r, file)
                    runs.append((at, file.tell()))
                    run, size = [], 0
            yield from heapq.merge(*(read_run(file, *r) for r in runs), sorted(run))

    def push(shard, frames, state):
        seen, held = state.get if state.exists else (0, [])
        held, out = list(held), []
        for _, row in in_order(keyed_rows(frames)):
            if len(held) < each:
                held.append(row)
            else:
                i = int(hashlib.md5(f"{seed}:{shard[0]}:{seen}".encode()).hexdigest()[:15], 16) % each
                out.append(held[i])
                held[i] = row
            seen += 1
            if len(out) == out_rows:
                yield pd.DataFrame({"row": out}, dtype=object)
                out = []
        state.update((seen, held))
        yield pd.DataFrame({"row": out}, dtype=object)

    # a string: pandas would take numbers as views of their Arrow batch, and the held batches would stay whole, each with a copy of the state
    keyed = stream.withColumn("_shard", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shards)).cast("string")).groupBy("_shard")
    pushed = keyed.applyInPandasWithState(push, "row string", "seen long, held array<string>", "append", GroupStateTimeout.NoTimeout)
    return _rows_of(pushed, stream.schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """Queries started here pass Arrow batches of ``rows`` rows to Python for as long as they run; the session's setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _rows_of(json_rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows from their JSON arrays."""
    cells = F.from_json("row", "array<string>")
    return json_rows.withColumn("_c", cells).select(*(F.col("_c")[i].cast(f.dataType).alias(f.name) for i, f in enumerate(schema)))


def drain_shuffle(spark: SparkSession, checkpoint_dir: str, schema: T.StructType) -> DataFrame:
    """The rows that a stopped ``shuffle_stream`` query still holds, read from its state store."""
    state = spark.read.format("statestore").load(checkpoint_dir)
    return _rows_of(state.select(F.explode(F.col("value.groupState.held")).alias("row")), schema)


TOTALS = ("seen", "ok", *Q.REASONS, "src_min_seq_len", "src_max_seq_len", "src_sum", "tgt_min_seq_len", "tgt_max_seq_len", "tgt_sum")


def total_columns() -> list:
    """Funnel and length totals of a classified frame."""
    return [*Q.reason_count_columns(),
            F.min("src_len").alias("src_min_seq_len"), F.max("src_len").alias("src_max_seq_len"), F.sum("src_len").alias("src_sum"),
            F.min("tgt_len").alias("tgt_min_seq_len"), F.max("tgt_len").alias("tgt_max_seq_len"), F.sum("tgt_len").alias("tgt_sum")]


@dataclass
class Ingest:
    """A running ingestion and what it has committed so far."""

    spark: SparkSession
    query: StreamingQuery
    out_dir: str

    def await_done(self) -> None:
        self.query.awaitTermination()

    def committed(self) -> list[int]:
        """Ids of the batches in the log."""
        return committed_batches(self.spark, self.out_dir)

    def rows(self) -> DataFrame:
        """The classified rows of all committed batches."""
        return ingested_rows(self.spark, self.out_dir)

    def latest_totals(self) -> DataFrame:
        """Running funnel and length profile of the committed batches: one row."""
        low, high = (F.min, "min"), (F.max, "max")
        kind = {c: low[0] if low[1] in c else high[0] if high[1] in c else F.sum for c in TOTALS}
        log = self.spark.read.schema(", ".join(f"{c} long" for c in TOTALS)).json(f"{self.out_dir}/log/*.json")
        return log.agg(*(kind[c](c).alias(c) for c in TOTALS))

    def stop(self) -> None:
        if self.query.isActive:
            self.query.stop()


def committed_batches(spark: SparkSession, out_dir: str) -> list[int]:
    fs, folder = fs_for(spark, f"{out_dir}/log")
    names = [st.getPath().getName() for st in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def ingested_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows of committed batches only; folders of a batch that was cut short are not read."""
    paths = [f"{out_dir}/rows/batch={b}" for b in committed_batches(spark, out_dir)]
    if not paths:
        raise FileNotFoundError(f"no batch is committed in {out_dir}")
    return spark.read.parquet(*paths)


def stream_ingest(spark: SparkSession, in_dir: str, out_dir: str, checkpoint_dir: str,
                  cfg: FilterConfig = FilterConfig(), max_files_per_trigger: int = 1, available_now: bool = True,
                  between: Callable[[int], None] | None = None) -> Ingest:
    """Classify arriving pairs; append rows; keep running totals. The input is read once.

    ``available_now`` drains what is there and stops (batch-style scheduling of a stream);
    otherwise the query keeps running with a processing-time trigger. ``between`` is called with the batch id after
    the rows and before the commit (for tests of a crash there).
    """
    out_dir = out_dir.rstrip("/")
    pairs = stream_pairs(spark, in_dir, cfg.lang_src, cfg.lang_tgt, max_files_per_trigger=max_files_per_trigger)
    classified = Q.classify(pairs, cfg)

    def commit(batch: DataFrame, batch_id: int) -> None:
        entry = f"{out_dir}/log/{batch_id:012d}.json"
        if path_exists(spark, entry):
            return  # committed before the crash
        seen = Observation(f"ingest-{batch_id}")
        batch.observe(seen, *total_columns()).write.mode("overwrite").parquet(f"{out_dir}/rows/batch={batch_id}")
        if between:
            between(batch_id)
        create_once(spark, entry, json.dumps(seen.get))

    trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
    query = classified.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint_dir).trigger(**trigger).start()
    return Ingest(spark, query, out_dir)
