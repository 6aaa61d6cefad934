"""Length profile (E1), per-row length series (E2) and named series.

E1 is one global aggregate (partial aggregation on every partition, a single tiny merge). The
averages are Python's ``round(sum / n, 3)`` reproduced exactly from the integer sums.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import text as T
from corpusprep.session import delete_path, path_exists

PROFILE_COLUMNS = [
    "n", "min_seq_len", "max_seq_len", "avg_seq_len",
    "src_min_seq_len", "src_max_seq_len", "src_avg_seq_len",
    "tgt_min_seq_len", "tgt_max_seq_len", "tgt_avg_seq_len",
]


def length_series(df: DataFrame, src: str = "src", tgt: str = "tgt", key: str | None = "row_key") -> DataFrame:
    """``id, src_len, tgt_len, max_len`` per row (``id`` = hash of the word lists).

    The word lists are generated once (see ``quality.classify``); hash and lengths are derived from them.
    """
    lists = F.struct(T.words(src).alias("s"), T.words(tgt).alias("t"))
    cols = [] if key is None else [F.col(key)]
    d = df.select(*cols, F.explode(F.array(lists)).alias("_w")).select(*cols, F.col("_w.s").alias("_s"), F.col("_w.t").alias("_t"))
    return d.select(
        *cols,
        T.id_of_words(F.concat("_s", "_t")).alias("id"),
        F.size("_s").alias("src_len"),
        F.size("_t").alias("tgt_len"),
        T.max_len(F.size("_s"), F.size("_t")).alias("max_len"),
    )


def length_profile(series: DataFrame) -> DataFrame:
    """E1 over a frame with ``src_len`` and ``tgt_len``: one row of PROFILE_COLUMNS.

    On empty input the min/max/avg columns are null (the job layer raises, as the reference's
    ``min()`` does).
    """
    agg = series.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("src_len").alias("smin"), F.max("src_len").alias("smax"), F.sum("src_len").alias("ssum"),
        F.min("tgt_len").alias("tmin"), F.max("tgt_len").alias("tmax"), F.sum("tgt_len").alias("tsum"),
    )
    return agg.select(
        F.col("n"),
        F.least("smin", "tmin").alias("min_seq_len"),
        F.greatest("smax", "tmax").alias("max_seq_len"),
        T.py_round_ratio(F.col("ssum") + F.col("tsum"), F.col("n") * 2).alias("avg_seq_len"),
        F.col("smin").alias("src_min_seq_len"),
        F.col("smax").alias("src_max_seq_len"),
        T.py_round_ratio(F.col("ssum"), F.col("n")).alias("src_avg_seq_len"),
        F.col("tmin").alias("tgt_min_seq_len"),
        F.col("tmax").alias("tgt_max_seq_len"),
        T.py_round_ratio(F.col("tsum"), F.col("n")).alias("tgt_avg_seq_len"),
    )


class SeriesStore:
    """Named series of rows, stored as a table partitioned by series (add / get / remove / info).

    A series is one partition: ``add`` overwrites only it, ``get`` and ``remove`` touch only it, and ``info`` counts
    rows without reading a payload.
    """

    SCHEMA = "payload string, key string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, key: str) -> str:
        names = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return f"{self.path}/{names.getPartitionPathString('key', key)}"

    def _check(self, key: str) -> None:
        if not isinstance(key, str) or not key:
            raise ValueError("a series needs a name")

    def add(self, key: str, rows: DataFrame) -> "SeriesStore":
        """Store ``rows`` as the series ``key``, in place of an earlier one. Rows must not be read from that series."""
        self._check(key)
        payload = rows.select(F.to_json(F.struct(*rows.columns)).alias("payload"), F.lit(key).alias("key"))
        payload.write.partitionBy("key").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return self

    def frame(self) -> DataFrame:
        """All series: ``payload, key``."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def get(self, key: str, schema: str | None = None) -> DataFrame | None:
        """The rows of a series, as JSON (``key, payload``) or parsed with ``schema``; None if there is none."""
        self._check(key)
        if not path_exists(self.spark, self._folder(key)):
            return None
        rows = self.frame().where(F.col("key") == key)
        return rows.select("key", "payload") if schema is None else rows.select(F.from_json("payload", schema).alias("_r")).select("_r.*")

    def remove(self, key: str) -> bool:
        """Whether there was such a series."""
        self._check(key)
        return delete_path(self.spark, self._folder(key))

    def info(self) -> DataFrame:
        """``key, rows``; from the file footers alone."""
        return self.frame().groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
