"""A training-data pipeline over ``documents``: filter, deduplicate, cut repeats, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of ``documents``.

Defined cases, for every stage: an empty table gives an empty one; extra columns pass through all stages but the last; a null
text has no words. It fails the quality rules, so later stages see none from here; alone, they treat it thus: no near
duplicate of anything (its row stays), nothing to cut, no contamination, one piece with the end token only. Rows that share key
and text are one document for the removal of repeats, and one group of near duplicates: one of them stays.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusprep.llm import decontaminate, lshforest, packing, quality_rules, repeats
from corpusprep.llm.queries import read, tokenizer_path
from corpusprep.session import shared_path, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep: each row is judged by its own text."""
    ship_package(spark)
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id. Texts without
    words are in no group."""
    ship_package(spark)
    return lshforest.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without copies of passages that stand elsewhere; ``n_chars`` follows the text. A document that is all copies goes;
    texts below the shortest passage stay as they are."""
    ship_package(spark)
    return repeats.remove(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items; without items, or without words, all stay."""
    ship_package(spark)
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences; an empty text is its end token."""
    ship_package(spark)
    return packing.pieces(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("jaccard_forest", near_duplicates),
    ("suffix_repeats", repeated_passages),
    ("decontaminate", benchmark_overlap),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage's rows are written below the shared folder."""
    docs = read(spark, sf_dir, "documents")
    folder = shared_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The packing ids come from a tokenizer file, which SQL has not; tests compare with a brute-force version.
ORACLE_SQL = None
