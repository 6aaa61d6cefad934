"""JSON Lines sources and sinks for pair data (A1-A5).

* A1 ``scan_pairs`` - explicit schema, ``FAILFAST`` (a malformed line is an error, as the
  reference's ``json.loads`` is), a missing path is an error.
* A4 ``flatten_translation`` - accepts ``{"translation": {en, fr}}`` and flat ``{en, fr}`` rows,
  also mixed in one input, and yields ``src, tgt``.
* A2 ``write_jsonl_exclusive`` - refuses an existing target (``errorifexists``).
* A3 ``export_jsonl`` - overwrite; ``ensure_ascii`` writes non-ASCII as ``\\uXXXX``.
* A5 ``hub_path`` / ``read_hub`` - a hub of datasets laid out ``<root>/<dataset>/lang=<pair>/
  split=<split>/``: a dataset is a folder, language pair and split are partition columns, so a
  choice of language or split prunes folders instead of filtering rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.session import list_dirs, path_exists


def pair_schema(lang_src: str = "en", lang_tgt: str = "fr") -> T.StructType:
    """Both accepted shapes in one schema: nested ``translation`` and flat language keys."""
    inner = T.StructType([T.StructField(lang_src, T.StringType()), T.StructField(lang_tgt, T.StringType())])
    return T.StructType(
        [T.StructField("translation", inner)]
        + [T.StructField(lang_src, T.StringType()), T.StructField(lang_tgt, T.StringType())]
    )


def flatten_translation(df: DataFrame, lang_src: str = "en", lang_tgt: str = "fr", keep: list[str] | None = None) -> DataFrame:
    """A4: ``row.get("translation", row)`` as columns ``src, tgt``.

    Raises ``KeyError`` naming the expected and present keys when a language is in neither shape
    (the schema check runs on the driver, before any job).
    """
    cols = set(df.columns)
    nested = set()
    if "translation" in cols and isinstance(df.schema["translation"].dataType, T.StructType):
        nested = set(df.schema["translation"].dataType.fieldNames())

    def side(lang: str):
        parts = []
        if lang in nested:
            parts.append(F.col("translation").getField(lang))
        if lang in cols:
            parts.append(F.col(lang))
        if not parts:
            raise KeyError(
                f"no column for language {lang!r}: a row must hold {lang_src!r} and {lang_tgt!r}, but the input has {sorted(cols | nested)}"
            )
        if lang in nested:  # nested wins when present, as row.get("translation", row) does
            return F.when(F.col("translation").isNotNull(), parts[0]).otherwise(parts[1] if len(parts) > 1 else F.lit(None))
        return parts[0]

    return df.select(*(keep or []), side(lang_src).alias("src"), side(lang_tgt).alias("tgt"))


def scan_pairs(spark: SparkSession, path: str, lang_src: str = "en", lang_tgt: str = "fr",
               extra: T.StructType | None = None) -> DataFrame:
    """A1 + A4: read JSON Lines pairs (UTF-8, one object per line) as ``[extra..], src, tgt``."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing to scan at {path!r}")
    schema = pair_schema(lang_src, lang_tgt)
    keep = []
    if extra is not None:
        for f in extra.fields:
            schema = schema.add(f)
            keep.append(f.name)
    raw = spark.read.schema(schema).option("mode", "FAILFAST").option("encoding", "UTF-8").json(path)
    return flatten_translation(raw, lang_src, lang_tgt, keep)


def with_row_key(df: DataFrame, key: str = "row_key") -> DataFrame:
    """Rows of files without a key get the hash of their content as ``key`` (equal pairs share it)."""
    if key in df.columns:
        return df
    from corpusprep.functions import text as TX

    return df.withColumn(key, TX.content_idx(F.coalesce("src", F.lit("")), F.coalesce("tgt", F.lit(""))))


def write_jsonl_exclusive(df: DataFrame, path: str) -> None:
    """A2: create; an existing target raises (``PATH_ALREADY_EXISTS``). Non-ASCII kept as is."""
    df.write.mode("errorifexists").option("encoding", "UTF-8").json(path)


def export_jsonl(df: DataFrame, path: str, ensure_ascii: bool = False) -> None:
    """A3: overwrite; ``ensure_ascii`` escapes non-ASCII characters (upper-case hex digits, which
    parse to the same strings as Python's lower-case ones)."""
    w = df.write.mode("overwrite").option("encoding", "UTF-8")
    if ensure_ascii:
        w = w.option("writeNonAsciiCharacterAsCodePoint", "true")
    w.json(path)


def hub_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"


def write_hub(df: DataFrame, root: str, dataset: str, mode: str = "errorifexists") -> None:
    """Lay out rows with ``lang`` and ``split`` columns as a hub dataset (JSON Lines)."""
    df.write.mode(mode).partitionBy("lang", "split").json(hub_path(root, dataset))


def read_hub(spark: SparkSession, root: str, dataset: str, lang: str | None = None, split: str | None = None,
             lang_src: str = "en", lang_tgt: str = "fr", extra: T.StructType | None = None) -> DataFrame:
    """A5: choose dataset + language pair + split. Unknown dataset, language or split raise
    ``ValueError`` listing what exists; the choice prunes partition folders."""
    base = hub_path(root, dataset)
    known = list_dirs(spark, root)
    if dataset not in known:
        raise ValueError(f"the hub has no dataset {dataset!r}, only {sorted(known)}")
    langs = [d.split("=", 1)[1] for d in list_dirs(spark, base) if d.startswith("lang=")]
    if lang is not None and lang not in langs:
        raise ValueError(f"{dataset!r} has no language pair {lang!r}, only {sorted(langs)}")
    splits = {d.split("=", 1)[1] for x in ([lang] if lang is not None else langs) for d in list_dirs(spark, f"{base}/lang={x}") if d.startswith("split=")}
    if split is not None and split not in splits:
        raise ValueError(f"{dataset!r} has no split {split!r}, only {sorted(splits)}")
    schema = pair_schema(lang_src, lang_tgt)
    keep = []
    if extra is not None:
        for f in extra.fields:
            schema = schema.add(f)
            keep.append(f.name)
    schema = schema.add("lang", T.StringType()).add("split", T.StringType())
    raw = spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", base).json(base)
    if lang is not None:
        raw = raw.where(F.col("lang") == lang)
    if split is not None:
        raw = raw.where(F.col("split") == split)
    return flatten_translation(raw, lang_src, lang_tgt, keep + ["lang", "split"])
