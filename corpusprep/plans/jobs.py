"""User-level jobs (J1-J4) and run metrics.

Each job is a lazy plan plus the few actions it needs. Metrics are collected with
``DataFrame.observe`` while the rows are written, so profiling and counting cost no extra pass.
"""
from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusprep.config import FilterConfig, RawConfig, VocabConfig
from corpusprep.functions import text as T
from corpusprep.operators import buckets as BK
from corpusprep.operators import collate as CL
from corpusprep.operators import quality as Q
from corpusprep.operators import sampling as S
from corpusprep.operators import vocab as V
from corpusprep.plans.catalog import Catalog, Dataset
from corpusprep.session import delete_path
from corpusprep.sources.jsonl import with_row_key


class RunMetrics:
    """Wall-clock start/end, duration (3 places) and throughput = rows / duration."""

    def __init__(self):
        self.started_at: datetime | None = None
        self.ended_at: datetime | None = None
        self.duration = 0.0
        self._t0 = 0.0

    def __enter__(self) -> "RunMetrics":
        self.started_at = datetime.now()
        self._t0 = time.perf_counter()
        return self

    def __exit__(self, *exc) -> None:
        self.ended_at = datetime.now()
        self.duration = round(time.perf_counter() - self._t0, 3)

    def throughput(self, rows: int) -> float:
        return round(rows / self.duration, 3) if self.duration > 0 else 0.0

    def as_dict(self) -> dict:
        return {"started_at": self.started_at.isoformat() if self.started_at else None,
                "ended_at": self.ended_at.isoformat() if self.ended_at else None, "duration": self.duration}


def with_positions(df: DataFrame, key: str = "row_key", skey: str = "skey") -> DataFrame:
    """The 1-based position of each row in the order ``(skey, key)`` as ``pos``, stored with the rows so access by
    index is a filter. Only names of rows are ordered (see ``ranking``)."""
    from corpusprep.operators.ranking import rank_within

    return rank_within(df, [], skey, key, out="pos")


def _profile_from(obs: dict) -> dict:
    """E1 from observed sums, rounded in Python exactly as the reference rounds."""
    n = int(obs["n"])
    if n == 0:
        raise ValueError("no rows, so no lengths to profile")
    ss, ts = int(obs["ssum"]), int(obs["tsum"])
    return {
        "n": n,
        "src_min_seq_len": int(obs["smin"]), "src_max_seq_len": int(obs["smax"]), "src_avg_seq_len": round(ss / n, 3),
        "tgt_min_seq_len": int(obs["tmin"]), "tgt_max_seq_len": int(obs["tmax"]), "tgt_avg_seq_len": round(ts / n, 3),
        "min_seq_len": min(int(obs["smin"]), int(obs["tmin"])), "max_seq_len": max(int(obs["smax"]), int(obs["tmax"])),
        "avg_seq_len": round((ss + ts) / (2 * n), 3),
    }


def extract_job(source: DataFrame, cfg: RawConfig, catalog: Catalog, force: bool = False) -> Dataset:
    """exists? -> seeded sample of n -> profile + length series -> add.

    ``source`` has ``src, tgt`` (e.g. ``scan_pairs``/``read_hub`` output or a table view) and, if rows have a
    key of their own, ``row_key``; otherwise the hash of the pair is the key.
    """
    if catalog.exists(cfg.dataset_id):
        if not force:
            return catalog.get(cfg.dataset_id)
        catalog.remove(cfg.dataset_id)
    with RunMetrics() as rm:
        sample = S.sample_n(with_row_key(source).select("row_key", "src", "tgt"), cfg.n, cfg.seed, shuffle=cfg.shuffle)
        rows = with_positions(sample.select(
            "row_key", "skey", "src", "tgt",
            T.word_count("src").alias("src_len"), T.word_count("tgt").alias("tgt_len"),
        ))
        obs = Observation("extract")
        rows = rows.observe(
            obs, F.count(F.lit(1)).alias("n"),
            F.min("src_len").alias("smin"), F.max("src_len").alias("smax"), F.sum("src_len").alias("ssum"),
            F.min("tgt_len").alias("tmin"), F.max("tgt_len").alias("tmax"), F.sum("tgt_len").alias("tsum"),
        )
        catalog.write_rows(cfg.dataset_id, rows)
        profile = _profile_from(obs.get)
        written = catalog.read_rows(cfg.dataset_id)
        series = written.select(
            "row_key", T.pair_id("src", "tgt").alias("id"), "src_len", "tgt_len", T.max_len("src_len", "tgt_len").alias("max_len")
        )
        catalog.write_series(cfg.dataset_id, series)
    metrics = {**profile, **rm.as_dict(), "throughput": rm.throughput(profile["n"])}
    ds = Dataset.create(cfg, metrics, written, profile["n"])
    catalog.commit(ds)
    return catalog.get(cfg.dataset_id)


def filter_job(catalog: Catalog, raw_id: str, force: bool = False, **overrides) -> Dataset:
    """J2 for one raw dataset: derive config -> classify -> first n valid -> ``idx, src, tgt`` -> add."""
    raw = catalog.get(raw_id)
    base = RawConfig(**{k: v for k, v in raw.config.items() if k in RawConfig.__dataclass_fields__})
    cfg = FilterConfig.from_config(base, **overrides)
    if catalog.exists(cfg.dataset_id):
        existing = catalog.get(cfg.dataset_id)
        if existing.parent_id not in (None, raw_id) and not force:
            raise FileExistsError(f"{cfg.dataset_id!r} was filtered from {existing.parent_id!r}, not from {raw_id!r}")
        if not force:
            return existing
        catalog.remove(cfg.dataset_id)
    with RunMetrics() as rm:
        classified = Q.classify(raw.rows.select("row_key", "src", "tgt"), cfg)
        res = S.first_n_valid(classified, cfg.n, cfg.seed)
        sel = with_positions(res.selected.select("row_key", "skey", "src", "tgt"))
        s_, t_ = T.strip_text("src"), T.strip_text("tgt")
        rows = sel.select(T.content_idx(s_, t_).alias("idx"), s_.alias("src"), t_.alias("tgt"), "pos")
        catalog.write_rows(cfg.dataset_id, rows)
        funnel = res.funnel.first().asDict()
        res.release()
    metrics = {**{k: int(v) for k, v in funnel.items()}, **rm.as_dict(), "throughput": rm.throughput(int(funnel["seen"]))}
    ds = Dataset.create(cfg, metrics, catalog.read_rows(cfg.dataset_id), funnel["selected"], parent_id=raw_id)
    catalog.commit(ds)
    return catalog.get(cfg.dataset_id)


def filter_all(catalog: Catalog, force: bool = False, **overrides) -> list[Dataset]:
    """J2 as in the notebook: every raw dataset in the registry."""
    ids = [r["id"] for r in catalog.show(stage="raw").select("id").collect()]
    return [filter_job(catalog, i, force=force, **overrides) for i in ids]


def vocab_job(catalog: Catalog, dataset_id: str, out_path: str, cfg: VocabConfig = VocabConfig(),
              max_merges: int | None = None, log=None) -> V.BpeModel:
    """Filtered rows -> interleaved texts -> vocabulary -> saved tables.

    Restartable: the state of learning lies in ``<out_path>.learning`` until the tables are saved. Called again after a
    lost driver, the job goes on behind the last committed round; if a vocabulary is there already, it is loaded.
    """
    spark = catalog.spark
    if V.BpeModel.saved(spark, out_path):
        return V.BpeModel.load(spark, out_path)
    state = f"{out_path.rstrip('/')}.learning"
    model = V.learn_bpe(V.corpus_texts(catalog.get(dataset_id).rows), cfg, max_merges=max_merges, state_path=state, log=log)
    model.save(spark, out_path, mode="overwrite")  # of a save that was cut short
    delete_path(spark, state)
    return model


def batch_job(rows: DataFrame, model: V.BpeModel, out_path: str | None = None, batch_size: int = 32,
              bucket_width: int = 16, l_src: int = 64, l_tgt: int = 64, drop_last: bool = False, seed: int = 42,
              epochs: int = 1, key: str | None = None) -> DataFrame:
    """Encode, bucket by source word count, collate, pack; optionally written partitioned by epoch.

    ``rows``: ``src, tgt`` and a key; by default ``row_key``, else ``pos`` or ``idx`` of a catalog dataset.
    """
    key = key or next((c for c in ("row_key", "pos", "idx") if c in rows.columns), "row_key")
    rows = rows.select(key, "src", "tgt")
    pad, bos, eos = (model.token_id(t) for t in ("<PAD>", "<BOS>", "<EOS>"))
    if None in (pad, bos, eos):
        raise ValueError("vocabulary lacks <PAD>, <BOS> or <EOS>")
    enc = V.encode(V.encode(rows, model, "src", "src_ids"), model, "tgt", "tgt_ids")
    enc = enc.withColumn("length", T.word_count("src"))
    layout = BK.bucket_batches(enc, "length", batch_size, bucket_width, drop_last, seed, epochs, key)
    coll = CL.collate_rows(layout, l_src=l_src, l_tgt=l_tgt, pad_id=pad, bos_id=bos, eos_id=eos)
    packed = CL.pack_batches(coll, ["epoch", "batch_index"], pad_id=pad)
    if out_path:
        packed.write.mode("errorifexists").partitionBy("epoch").parquet(out_path)
    return packed


def run_notebook(source: Callable[[str], DataFrame], catalog: Catalog, splits=("train",), n: int = 50000) -> list[Dataset]:
    """Extract each split, then filter every raw set. ``source`` gives the pairs of a split; it raises for one that it lacks."""
    out = [extract_job(source(split), RawConfig(split=split, n=n), catalog) for split in splits]
    return out + filter_all(catalog)
