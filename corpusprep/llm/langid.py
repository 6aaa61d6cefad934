"""Language of web pages by fusing four kinds of evidence with Bayes' rule.

    P(language | page) ~ P(text | language)^temper * P(declared | language) * P(suffix | language) * P(language | host)

* *Text*: hashed byte n-gram models, fitted on labelled texts. Neighbouring n-grams overlap, so the
  likelihood is tempered.
* *Declared* language of the markup and address *suffix*: their likelihoods are counted over all pages,
  each page counting by its text posterior, so a site that declares a wrong language, or a suffix that
  says nothing, loses its weight by itself.
* *Host* prior: the mean text posterior of the host's other pages, smoothed by that of the domain, and
  that by all pages' (Dirichlet smoothing with ``strength`` pseudo-pages a level; a page never counts for itself).

Counts are grouped aggregations, pre-aggregated before their shuffle, and go back by equi-joins on narrow
rows, so a host with a third of all pages is no bottleneck. The models are fitted on about ``fit_rows``
labelled texts a language, chosen by hash; everything else covers all pages.

Defined cases: null markup or address give no evidence of that kind (a null address has the host ``''``); a
page without text is judged by the rest; repeated pages count as often as they occur; an empty table
gives no rows; without labelled texts the language is null.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.textbuf import LOWER, U64, runs, text_bytes
from corpusprep.llm.wrappers import HOST, Page, main_text
from corpusprep.session import ensure_checkpoint_dir

MAX_LANGUAGES = 500


@dataclass(frozen=True)
class Evidence:
    """``sizes``: n-gram lengths in bytes; ``temper``: exponent of the text likelihood; ``smoothing``: pseudo-counts of the counted likelihoods."""

    sizes: tuple[int, ...] = (2, 4)
    buckets: int = 1 << 15
    fit_rows: int = 2_000
    temper: float = 0.25
    strength: float = 5.0
    smoothing: float = 0.5


def features(texts: list[bytes], how: Evidence) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every byte n-gram; all but letters and bytes beyond ASCII is one blank."""
    buf = LOWER[np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)]
    letter = (buf >= 0x80) | ((buf >= 0x61) & (buf <= 0x7A))
    keep = letter | np.append(True, letter[:-1])  # the first of several blanks stays
    doc = np.repeat(np.arange(len(texts) + 1), np.fromiter((1 + len(t) for t in [*texts, b""]), np.int64, len(texts) + 1))[: len(buf)]
    doc = np.minimum(doc, max(len(texts) - 1, 0))
    buf, doc, letter = np.where(letter, buf, 0x20)[keep].astype(U64), doc[keep], letter[keep]
    out: tuple[list, list] = ([], [])
    for n in how.sizes:
        m = len(buf) - n + 1
        if m <= 0:
            continue
        x = np.full(m, n, U64)
        some = np.zeros(m, bool)
        for k in range(n):
            x = x * U64(0x9E3779B97F4A7C15) + buf[k: k + m]
            some |= letter[k: k + m]
        ok = some & (doc[:m] == doc[n - 1:])
        out[0].append(doc[:m][ok])
        out[1].append(((x[ok] * U64(0xC2B2AE3D27D4EB4F)) >> U64(40)) % U64(how.buckets))
    if not out[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out[0]), np.concatenate(out[1]).astype(np.int64)


def fit(labelled: DataFrame, lang: str, text: str, key: str, how: Evidence) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities (language x bucket) of their n-grams."""
    sizes = {r[0]: r[1] for r in labelled.where(F.col(lang).isNotNull()).groupBy(lang).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(sizes)
    rate = F.create_map(*(F.lit(x) for n in names for x in (n, min(1.0, how.fit_rows / sizes[n])))) if names else F.lit(None)
    sample = labelled.where(F.col(lang).isNotNull()).where(F.pmod(F.xxhash64(F.lit("fit"), key), F.lit(1 << 20)) < rate[F.col(lang)] * (1 << 20)) if names else labelled.limit(0)
    index = {n: i for i, n in enumerate(names)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(names) * how.buckets, np.int64)
        with np.errstate(over="ignore"):
            for batch in batches:
                of = np.array([index[x] for x in batch.column(0).to_pylist()], np.int64)
                texts = text_bytes(batch.column(1))
                for a, b in runs(texts):
                    doc, bucket = features(texts[a:b], how)
                    counts += np.bincount(of[a:b][doc] * how.buckets + bucket, minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["cell", "n"])

    model = np.ones(len(names) * how.buckets)
    if names:
        for cell, n in sample.select(lang, text).mapInArrow(scan, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # languages x buckets
            model[cell] += n
    model = model.reshape(len(names), how.buckets)
    return names, np.log(model / model.sum(axis=1, keepdims=True))


DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]{2,3})", re.I)
META = re.compile(r"<meta\b[^>]*http-equiv\s*=\s*[\"']?content-language[\"']?[^>]*content\s*=\s*[\"']?\s*([A-Za-z]{2,3})", re.I)


def visible(markup: str) -> str:
    """The page's main text; if it has none, all its text."""
    page = Page(markup)
    return main_text(page, set()) or "\n".join(page.texts)


def declared(markup: str) -> str | None:
    m = DECLARED.search(markup) or META.search(markup)
    return m[1].lower() if m else None


def address(url: str | None) -> tuple[str, str, str | None]:
    """(host, domain, suffix)."""
    m = HOST.match(url or "")
    host = m[1].lower().strip(".") if m else ""
    labels = host.split(".")
    named = len(labels) > 1 and not labels[-1].isdigit()
    return host, ".".join(labels[-2:]) if named else host, labels[-1] if named else None


def _read(model, how: Evidence):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = model.value
        with np.errstate(over="ignore"):
            for batch in batches:
                urls, pages = batch.column(1).to_pylist(), [p or "" for p in batch.column(2).to_pylist()]
                texts = [visible(p).encode() for p in pages]
                for a, b in runs(texts):
                    doc, bucket = features(texts[a:b], how)
                    score = np.stack([np.bincount(doc, logs[k][bucket], minlength=b - a) for k in range(len(names))], axis=1) * how.temper
                    places = [address(u) for u in urls[a:b]]
                    said = [declared(p) for p in pages[a:b]]
                    part = batch.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), *(pa.array([p[k] for p in places], pa.string()) for k in range(3)), pa.array(said, pa.string()),
                         pa.array(np.bincount(doc, minlength=b - a)), pa.array(list(score - score.max(axis=1, keepdims=True)), pa.list_(pa.float64()))],
                        names=["key", "url", "host", "domain", "suffix", "declared", "n_grams", "loglik"])

    return scan


def identify(pages: DataFrame, labelled: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html", lang: str = "lang",
             text: str = "text", label_key: str = "doc_id", how: Evidence | None = None) -> DataFrame:
    """One row per page: ``key, url, lang, probability, text_lang, declared, suffix, host, n_grams``."""
    how = how or Evidence()
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    names, logs = fit(labelled, lang, text, label_key, how)
    kind = pages.schema[key].dataType.simpleString()
    columns = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(markup).alias("markup"))
    if not names:
        none = F.lit(None).cast("string")
        return columns.select(F.col("key").alias(key), F.col("url").alias(url), none.alias("lang"), F.lit(None).cast("double").alias("probability"),
                              none.alias("text_lang"), none.alias("declared"), none.alias("suffix"), none.alias("host"), F.lit(0).cast("long").alias("n_grams"))
    read = columns.mapInArrow(_read(spark.sparkContext.broadcast((names, logs)), how),
                              f"key {kind}, url string, host string, domain string, suffix string, declared string, n_grams long, loglik array<double>")
    n = len(names)
    known = F.when(F.col("declared").isin(names), F.col("declared")).when(F.col("declared").isNotNull(), "?").otherwise("-")
    weight = F.transform("loglik", lambda x: F.exp(x))
    total = F.aggregate(weight, F.lit(0.0), lambda a, x: a + x)
    read = read.withColumn("said", known).withColumn("zone", F.coalesce("suffix", F.lit("-")))
    read = read.select("*", *((weight[i] / total).alias(f"r{i}") for i in range(n))).checkpoint()
    r = [f"r{i}" for i in range(n)]

    def sums(by: list[str], name: str) -> DataFrame:
        return read.groupBy(*by).agg(F.struct(*(F.sum(c).alias(c) for c in r)).alias(name))

    overall = read.agg(*(F.coalesce(F.sum(c), F.lit(0.0)) for c in r)).first()
    pages_n = sum(overall)
    zones = read.select("zone").distinct().count()
    out = (read.join(sums(["said"], "s"), "said").join(sums(["zone"], "z"), "zone")
           .join(sums(["host"], "h"), "host").join(sums(["domain"], "d"), "domain"))
    a, e = how.strength, how.smoothing

    def levels(i: int):
        others = F.lit(float(pages_n)) - 1
        everyone = (F.lit(overall[i]) - F.col(r[i]) + a / n) / (others + a)
        size = {x: sum((F.col(f"{x}.{c}") for c in r), F.lit(-1.0)) for x in "dh"}  # without the page itself
        domain = (F.col(f"d.{r[i]}") - F.col(r[i]) + a * everyone) / (size["d"] + a)
        return (F.col(f"h.{r[i]}") - F.col(r[i]) + a * domain) / (size["h"] + a)

    def likelihood(x: str, values: float, i: int):
        return (F.col(f"{x}.{r[i]}") - F.col(r[i]) + e) / (F.lit(overall[i]) - F.col(r[i]) + e * values)

    logp = [F.col("loglik")[i] + F.log(likelihood("s", n + 2, i)) + F.log(likelihood("z", max(zones, 1), i)) + F.log(F.greatest(levels(i), F.lit(1e-12)))
            for i in range(n)]
    out = out.withColumn("logp", F.array(*logp)).withColumn("top", F.array_max("logp"))
    name = F.array(*map(F.lit, names))
    probability = 1 / F.aggregate(F.transform("logp", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda s, x: s + x)
    best = lambda c: F.element_at(name, F.array_position(c, F.array_max(c)).cast("int"))
    return out.select(F.col("key").alias(key), F.col("url").alias(url), best(F.col("logp")).alias("lang"), F.round(probability, 6).alias("probability"),
                      F.when(F.col("n_grams") > 0, best(F.col("loglik"))).alias("text_lang"), "declared", "suffix", "host", "n_grams")
