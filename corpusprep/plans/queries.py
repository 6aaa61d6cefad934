"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (``documents`` and ``conversations`` hold the text; the
``embeddings`` vectors serve as model scores) and runs over whole tables. Matching DuckDB SQL is
in ``ORACLE``; of results that SQL cannot reproduce (time stamps, learned merges) it checks what it can, and
learning itself is compared with a library in the tests.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.config import FilterConfig
from corpusprep.functions import text as T
from corpusprep.operators import quality as Q
from corpusprep.operators import sampling as S
from corpusprep.operators.profile import length_profile, length_series
from corpusprep.plans import oracle_sql as O
from corpusprep.sources.tables import conversation_pairs, documents_pairs

SEED = 42
FIRST_N = 100  # the first-n walk stops at the 100th valid pair (FIXTURES §4 scenario)
SAMPLE_N = 64  # raw extraction sample size, as the reference's 64-row test split

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.classify(documents_pairs(spark, sf_dir), FilterConfig())


# ---- A: sources ----------------------------------------------------------------------------------


@register("pairs_view", f"WITH {O.PAIRS} SELECT row_key, src, tgt, lang, source FROM pairs")
def q_pairs_view(spark, sf_dir):
    return documents_pairs(spark, sf_dir)


@register(
    "turn_pairs",
    f"WITH {O.TURN_PAIRS}, {O.classified('turn_pairs', 'c')} SELECT row_key, src_len, tgt_len, reason FROM c",
)
def q_turn_pairs(spark, sf_dir):
    return Q.classify(conversation_pairs(spark, sf_dir), FilterConfig()).select("row_key", "src_len", "tgt_len", "reason")


@register(
    "pairs_coverage",
    "SELECT doc_id, CAST(length(replace(coalesce(text, ''), chr(10), '')) AS BIGINT) AS n_chars FROM documents",
)
def q_pairs_coverage(spark, sf_dir):
    """Characters of all pairs of a document: nothing but its line breaks is left out."""
    p = documents_pairs(spark, sf_dir).withColumn("doc_id", F.substring_index("row_key", ":", 1).cast("long"))
    return p.groupBy("doc_id").agg(F.sum(F.length("src") + F.length("tgt")).cast("long").alias("n_chars"))


# ---- B: sampling ---------------------------------------------------------------------------------


@register(
    "sample_n",
    f"WITH {O.PAIRS}, k AS (SELECT *, {O.shuffle_key(SEED, 'row_key')} AS skey FROM pairs) "
    f"SELECT row_key, skey, src, tgt FROM k ORDER BY skey, row_key LIMIT {SAMPLE_N}",
)
def q_sample_n(spark, sf_dir):
    return S.sample_n(documents_pairs(spark, sf_dir), SAMPLE_N, SEED).select("row_key", "skey", "src", "tgt")


@register(
    "shuffle_full",
    f"WITH {O.PAIRS} SELECT row_key, {O.shuffle_key(SEED, 'row_key')} AS skey, "
    f"row_number() OVER (ORDER BY {O.shuffle_key(SEED, 'row_key')}, row_key) AS position FROM pairs",
)
def q_shuffle_full(spark, sf_dir):
    return S.shuffle_positions(documents_pairs(spark, sf_dir).select("row_key"), SEED).select(
        "row_key", "skey", F.col("position").cast("long").alias("position")
    )


@register(
    "first_n_valid",
    f"WITH {O.PAIRS}, {O.first_n_window(FIRST_N, SEED)} SELECT row_key, src, tgt FROM win WHERE reason IS NULL",
)
def q_first_n_valid(spark, sf_dir):
    r = S.first_n_valid(_classified(spark, sf_dir), FIRST_N, SEED)
    return r.selected.select("row_key", "src", "tgt")


# ---- C: scalar text functions --------------------------------------------------------------------


@register(
    "word_count",
    f"WITH {O.PAIRS} SELECT row_key, {O.word_count('src')} AS src_len, {O.word_count('tgt')} AS tgt_len FROM pairs",
)
def q_word_count(spark, sf_dir):
    p = documents_pairs(spark, sf_dir)
    return p.select("row_key", T.word_count("src").alias("src_len"), T.word_count("tgt").alias("tgt_len"))


@register(
    "word_split",
    f"WITH {O.PAIRS} SELECT row_key, 'src' AS side, pos - 1 AS pos, w AS word FROM pairs, unnest({O.words('src')}) WITH ORDINALITY AS t(w, pos) "
    f"UNION ALL SELECT row_key, 'tgt', pos - 1, w FROM pairs, unnest({O.words('tgt')}) WITH ORDINALITY AS t(w, pos)",
)
def q_word_split(spark, sf_dir):
    """The words of both sides."""
    p = documents_pairs(spark, sf_dir)
    sides = F.inline(F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).alias("text")) for c in ("src", "tgt"))))
    return p.select("row_key", sides).select("row_key", "side", F.posexplode(T.words("text")).alias("pos", "word")).select(
        "row_key", "side", F.col("pos").cast("long").alias("pos"), "word"
    )


@register(
    "strip_text",
    f"WITH {O.PAIRS} SELECT row_key, {O.strip('src')} AS src, {O.strip('tgt')} AS tgt FROM pairs",
)
def q_strip_text(spark, sf_dir):
    p = documents_pairs(spark, sf_dir)
    return p.select("row_key", T.strip_text("src").alias("src"), T.strip_text("tgt").alias("tgt"))


@register(
    "content_idx",
    f"WITH {O.PAIRS}, s AS (SELECT row_key, {O.strip('src')} AS src, {O.strip('tgt')} AS tgt FROM pairs) "
    f"SELECT row_key, {O.content_idx('src', 'tgt')} AS idx FROM s",
)
def q_content_idx(spark, sf_dir):
    p = documents_pairs(spark, sf_dir).select("row_key", T.strip_text("src").alias("src"), T.strip_text("tgt").alias("tgt"))
    return p.select("row_key", T.content_idx("src", "tgt").alias("idx"))


@register("pair_id", f"WITH {O.PAIRS} SELECT row_key, {O.pair_id('src', 'tgt')} AS id FROM pairs")
def q_pair_id(spark, sf_dir):
    return documents_pairs(spark, sf_dir).select("row_key", T.pair_id("src", "tgt").alias("id"))


@register(
    "project_clean",
    f"WITH {O.PAIRS}, {O.classified('pairs', 'c')}, s AS (SELECT {O.strip('src')} AS src, {O.strip('tgt')} AS tgt "
    f"FROM c WHERE reason IS NULL) SELECT {O.content_idx('src', 'tgt')} AS idx, src, tgt FROM s",
)
def q_project_clean(spark, sf_dir):
    return Q.project_clean(Q.filter_valid(_classified(spark, sf_dir)))


@register(
    "word_cap",
    f"WITH {O.PAIRS}, {O.classified('pairs', 'c')} SELECT row_key, src_len, tgt_len, "
    f"src_len <= {FilterConfig().src_max_words} AS src_within_cap, tgt_len <= {FilterConfig().tgt_max_words} AS tgt_within_cap FROM c",
)
def q_word_cap(spark, sf_dir):
    cfg = FilterConfig()
    c = _classified(spark, sf_dir)
    return c.select(
        "row_key", "src_len", "tgt_len",
        (F.col("src_len") <= cfg.src_max_words).alias("src_within_cap"),
        (F.col("tgt_len") <= cfg.tgt_max_words).alias("tgt_within_cap"),
    )


# ---- D: predicates --------------------------------------------------------------------------------


@register(
    "reject_reason",
    f"WITH {O.PAIRS}, {O.classified('pairs', 'c')} SELECT row_key, src_len, tgt_len, reason FROM c",
)
def q_reject_reason(spark, sf_dir):
    return _classified(spark, sf_dir).select("row_key", "src_len", "tgt_len", "reason")


@register(
    "length_ratio",
    f"WITH {O.PAIRS}, {O.classified('pairs', 'c')} SELECT row_key, CASE WHEN least(src_len, tgt_len) <= 0 THEN FALSE "
    f"ELSE CAST(greatest(src_len, tgt_len) AS DOUBLE) / CAST(least(src_len, tgt_len) AS DOUBLE) <= 2.0 END AS ratio_ok FROM c",
)
def q_length_ratio(spark, sf_dir):
    c = _classified(spark, sf_dir)
    return c.select("row_key", Q.ratio_ok("src_len", "tgt_len", FilterConfig().ratio_max).alias("ratio_ok"))


@register(
    "filter_valid",
    f"WITH {O.PAIRS}, {O.classified('pairs', 'c')} SELECT row_key, src, tgt, src_len, tgt_len FROM c WHERE reason IS NULL",
)
def q_filter_valid(spark, sf_dir):
    return Q.filter_valid(_classified(spark, sf_dir)).select("row_key", "src", "tgt", "src_len", "tgt_len")


@register("reason_counts", f"WITH {O.PAIRS}, {O.classified('pairs', 'c')} {O.reason_counts_select('c')}")
def q_reason_counts(spark, sf_dir):
    return Q.reason_counts(_classified(spark, sf_dir))


# ---- E: aggregates ---------------------------------------------------------------------------------


def _profile_sql(view: str) -> str:
    return (
        f"WITH {O.PAIRS}, l AS (SELECT {O.word_count('src')} AS s, {O.word_count('tgt')} AS t FROM {view}), "
        "a AS (SELECT count(*) AS n, min(s) AS smin, max(s) AS smax, sum(s) AS ssum, min(t) AS tmin, max(t) AS tmax, "
        "sum(t) AS tsum FROM l) "
        "SELECT n, least(smin, tmin) AS min_seq_len, greatest(smax, tmax) AS max_seq_len, "
        f"{O.round_ratio('ssum + tsum', 'n * 2')} AS avg_seq_len, smin AS src_min_seq_len, smax AS src_max_seq_len, "
        f"{O.round_ratio('ssum', 'n')} AS src_avg_seq_len, tmin AS tgt_min_seq_len, tmax AS tgt_max_seq_len, "
        f"{O.round_ratio('tsum', 'n')} AS tgt_avg_seq_len FROM a"
    )


@register("length_profile", _profile_sql("pairs"))
def q_length_profile(spark, sf_dir):
    p = documents_pairs(spark, sf_dir)
    return length_profile(p.select(T.word_count("src").alias("src_len"), T.word_count("tgt").alias("tgt_len")))


@register(
    "length_series",
    f"WITH {O.PAIRS} SELECT row_key, {O.pair_id('src', 'tgt')} AS id, {O.word_count('src')} AS src_len, "
    f"{O.word_count('tgt')} AS tgt_len, greatest({O.word_count('src')}, {O.word_count('tgt')} + 1) AS max_len FROM pairs",
)
def q_length_series(spark, sf_dir):
    return length_series(documents_pairs(spark, sf_dir))


@register("filter_funnel", f"WITH {O.PAIRS}, {O.first_n_window(FIRST_N, SEED)} {O.funnel_select()}")
def q_filter_funnel(spark, sf_dir):
    return S.first_n_valid(_classified(spark, sf_dir), FIRST_N, SEED).funnel


@register(
    "turn_funnel",
    f"WITH {O.TURN_PAIRS}, {O.first_n_window(FIRST_N, SEED, 'turn_pairs')} {O.funnel_select()}",
)
def q_turn_funnel(spark, sf_dir):
    c = Q.classify(conversation_pairs(spark, sf_dir), FilterConfig())
    return S.first_n_valid(c, FIRST_N, SEED).funnel


# ---- shared inputs for layout / collation ------------------------------------------------------------

from corpusprep.functions import arrays as A  # noqa: E402
from corpusprep.operators import buckets as BK  # noqa: E402
from corpusprep.operators import collate as CL  # noqa: E402
from corpusprep.operators import evaluate as EV  # noqa: E402
from corpusprep.sources.tables import table  # noqa: E402

BATCH = 8
WIDTH = 16
L_SEQ = 64
T_CTX = 32


def _clean(spark, sf_dir):
    """Valid pairs, stripped, with their word counts (the filtered corpus, full scan)."""
    v = Q.filter_valid(_classified(spark, sf_dir))
    return v.select("row_key", T.strip_text("src").alias("src"), T.strip_text("tgt").alias("tgt"), "src_len", "tgt_len")


_CLEAN_SQL = f"WITH {O.PAIRS}, {O.classified('pairs', 'c')}, {O.CLEAN}"


def _bucket_sql(drop_last: bool = False, epochs: int = 1) -> str:
    ep = "(SELECT CAST(range AS INTEGER) AS epoch FROM range(" + str(epochs) + "))"
    keep = f"WHERE cnt = {BATCH}" if drop_last else ""
    return (
        f"{_CLEAN_SQL}, e AS {ep}, "
        "b AS (SELECT clean.row_key, e.epoch, CAST(floor(src_len / " + str(WIDTH) + ") AS INTEGER) AS bucket_id, "
        "row_number() OVER (PARTITION BY e.epoch, CAST(floor(src_len / " + str(WIDTH) + ") AS INTEGER) "
        "ORDER BY md5(CAST(42 + e.epoch AS VARCHAR) || ':' || CAST(clean.row_key AS VARCHAR)), clean.row_key) AS rn "
        "FROM clean, e), "
        f"ch AS (SELECT *, CAST((rn - 1) // {BATCH} AS INTEGER) AS chunk, CAST((rn - 1) % {BATCH} AS INTEGER) AS pos FROM b), "
        "k AS (SELECT epoch, bucket_id, chunk, count(*) AS cnt FROM ch GROUP BY ALL), "
        "o AS (SELECT epoch, bucket_id, chunk, row_number() OVER (PARTITION BY epoch ORDER BY chunk, bucket_id) - 1 AS batch_index "
        f"FROM k {keep}), "
        "bb AS (SELECT ch.row_key, ch.epoch, ch.bucket_id, CAST(ch.rn AS BIGINT) AS rn, ch.chunk, ch.pos, "
        "CAST(o.batch_index AS BIGINT) AS batch_index FROM ch JOIN o USING (epoch, bucket_id, chunk))"
    )


def _layout(rows, drop_last=False, epochs=1):
    return BK.bucket_batches(rows, "src_len", BATCH, WIDTH, drop_last=drop_last, seed=SEED, epochs=epochs)


def _batches(spark, sf_dir, drop_last=False, epochs=1):
    return _layout(_clean(spark, sf_dir), drop_last, epochs).select(
        "row_key", F.col("epoch").cast("int").alias("epoch"), "bucket_id", F.col("rn").cast("long").alias("rn"),
        "chunk", "pos", F.col("batch_index").cast("long").alias("batch_index"),
    )


# ---- F: bucketing ------------------------------------------------------------------------------------


@register(
    "bucket_id",
    f"{_CLEAN_SQL} SELECT row_key, src_len, CAST(floor(src_len / {WIDTH}) AS INTEGER) AS bucket_id FROM clean",
)
def q_bucket_id(spark, sf_dir):
    return _clean(spark, sf_dir).select("row_key", "src_len", BK.bucket_id("src_len", WIDTH).alias("bucket_id"))


@register("bucket_shuffle", f"{_bucket_sql()} SELECT row_key, epoch, bucket_id, CAST(rn AS BIGINT) AS rn FROM b")
def q_bucket_shuffle(spark, sf_dir):
    s = BK.bucket_shuffle(_clean(spark, sf_dir), "src_len", WIDTH, SEED)
    return s.select("row_key", F.col("epoch").cast("int").alias("epoch"), "bucket_id", F.col("rn").cast("long").alias("rn"))


@register("bucket_batches", f"{_bucket_sql()} SELECT * FROM bb")
def q_bucket_batches(spark, sf_dir):
    return _batches(spark, sf_dir)


@register("drop_last", f"{_bucket_sql(drop_last=True)} SELECT * FROM bb")
def q_drop_last(spark, sf_dir):
    return _batches(spark, sf_dir, drop_last=True)


@register("epoch_plan", f"{_bucket_sql(epochs=2)} SELECT * FROM bb")
def q_epoch_plan(spark, sf_dir):
    return _batches(spark, sf_dir, epochs=2)


@register(
    "batch_count",
    f"{_CLEAN_SQL}, k AS (SELECT floor(src_len / {WIDTH}) AS b, count(*) AS cnt FROM clean GROUP BY 1) "
    f"SELECT CAST(coalesce(sum(ceil(cnt / {BATCH})), 0) AS BIGINT) AS n_batches, "
    f"CAST(coalesce((sum(cnt) + {BATCH - 1}) // {BATCH}, 0) AS BIGINT) AS batch_count_estimate FROM k",
)
def q_batch_count(spark, sf_dir):
    return BK.batch_count(_clean(spark, sf_dir), "src_len", BATCH, WIDTH)


# ---- H: collation (character-level stand-in ids) --------------------------------------------------------


def _with_ids(spark, sf_dir):
    c = _clean(spark, sf_dir)
    return c.select("row_key", "src_len", A.char_ids("src").alias("src_ids"), A.char_ids("tgt").alias("tgt_ids"))


def _ids(spark, sf_dir):
    return _with_ids(spark, sf_dir).drop("src_len")


_IDS_SQL = f"{_CLEAN_SQL}, ids AS (SELECT row_key, {O.char_ids('src')} AS src_ids, {O.char_ids('tgt')} AS tgt_ids FROM clean)"
_PADDED_SQL = f"{_IDS_SQL}, pt AS (SELECT row_key, {O.pad_truncate('src_ids', L_SEQ, CL.PAD_ID)} AS enc, {O.pad_truncate('tgt_ids', L_SEQ, CL.PAD_ID)} AS tgt FROM ids)"


@register("pad_truncate", f"{_PADDED_SQL} SELECT row_key, enc AS encoder_input_ids FROM pt")
def q_pad_truncate(spark, sf_dir):
    return _ids(spark, sf_dir).select("row_key", A.pad_truncate("src_ids", L_SEQ, CL.PAD_ID).alias("encoder_input_ids"))


@register(
    "decoder_input",
    f"{_PADDED_SQL} SELECT row_key, list_concat([{CL.BOS_ID}], list_slice(tgt, 1, {L_SEQ - 1})) AS decoder_input_ids FROM pt",
)
def q_decoder_input(spark, sf_dir):
    t = A.pad_truncate("tgt_ids", L_SEQ, CL.PAD_ID)
    return _ids(spark, sf_dir).select("row_key", A.decoder_input(t, L_SEQ, CL.BOS_ID).alias("decoder_input_ids"))


@register(
    "labels",
    f"{_PADDED_SQL} SELECT row_key, list_concat(list_slice(tgt, 1, {L_SEQ - 1}), [{CL.EOS_ID}]) AS labels FROM pt",
)
def q_labels(spark, sf_dir):
    t = A.pad_truncate("tgt_ids", L_SEQ, CL.PAD_ID)
    return _ids(spark, sf_dir).select("row_key", A.labels(t, L_SEQ, CL.EOS_ID).alias("labels"))


@register(
    "attention_mask",
    f"{_PADDED_SQL} SELECT row_key, list_transform(enc, lambda x: x <> {CL.PAD_ID}) AS encoder_attn_mask, "
    f"list_transform(list_concat([{CL.BOS_ID}], list_slice(tgt, 1, {L_SEQ - 1})), lambda x: x <> {CL.PAD_ID}) AS decoder_attn_mask FROM pt",
)
def q_attention_mask(spark, sf_dir):
    c = CL.collate_rows(_ids(spark, sf_dir), l_src=L_SEQ, l_tgt=L_SEQ)
    return c.select("row_key", "encoder_attn_mask", "decoder_attn_mask")


@register(
    "pad_to_batch_max",
    f"{_bucket_sql()}, {_IDS_SQL[len(_CLEAN_SQL) + 2:]}, j AS (SELECT bb.epoch, bb.batch_index, bb.row_key, "
    f"ids.src_ids AS s, ids.tgt_ids AS t FROM bb JOIN ids USING (row_key)) "
    f"SELECT epoch, batch_index, row_key, list_resize(s, max(len(s)) OVER (PARTITION BY epoch, batch_index), {CL.PAD_ID}) AS src_ids, "
    f"list_resize(t, max(len(t)) OVER (PARTITION BY epoch, batch_index), {CL.PAD_ID}) AS tgt_ids FROM j",
)
def q_pad_to_batch_max(spark, sf_dir):
    """H5: both sides padded to the longest of their batch."""
    b = _layout(_with_ids(spark, sf_dir)).select("epoch", "batch_index", "row_key", "src_ids", "tgt_ids")
    return CL.pad_to_batch_max(CL.pad_to_batch_max(b, "src_ids", ["epoch", "batch_index"]), "tgt_ids", ["epoch", "batch_index"])


@register(
    "pack_batches",
    f"{_bucket_sql()}, {_PADDED_SQL[len(_CLEAN_SQL) + 2:]}, r AS (SELECT bb.epoch, bb.batch_index, bb.pos, "
    f"CAST(pt.enc AS INTEGER[]) AS encoder_input_ids, CAST(list_concat([{CL.BOS_ID}], list_slice(pt.tgt, 1, {L_SEQ - 1})) AS INTEGER[]) AS decoder_input_ids, "
    f"CAST(list_concat(list_slice(pt.tgt, 1, {L_SEQ - 1}), [{CL.EOS_ID}]) AS INTEGER[]) AS labels FROM bb JOIN pt USING (row_key)) "
    "SELECT epoch, batch_index, count(*) AS batch_rows, list(encoder_input_ids ORDER BY pos) AS encoder_input_ids, "
    "list(decoder_input_ids ORDER BY pos) AS decoder_input_ids, list(labels ORDER BY pos) AS labels, "
    f"list(list_transform(encoder_input_ids, lambda x: x <> {CL.PAD_ID}) ORDER BY pos) AS encoder_attn_mask, "
    f"list(list_transform(decoder_input_ids, lambda x: x <> {CL.PAD_ID}) ORDER BY pos) AS decoder_attn_mask, "
    f"{CL.PAD_ID} AS pad_id FROM r GROUP BY epoch, batch_index",
)
def q_pack_batches(spark, sf_dir):
    b = _layout(_with_ids(spark, sf_dir)).select("epoch", "batch_index", "pos", "src_ids", "tgt_ids")
    return CL.pack_batches(CL.collate_rows(b, l_src=L_SEQ, l_tgt=L_SEQ), ["epoch", "batch_index"])


@register(
    "next_token_pairs",
    "WITH d AS (SELECT doc_id, " + O.char_ids("coalesce(text, '')") + " AS ids FROM documents WHERE length(coalesce(text, '')) >= 2), "
    f"w AS (SELECT doc_id, ids, CAST(k.range AS INTEGER) AS k FROM d, range(0, CAST(ceil((len(ids) - 1) / {T_CTX}) AS BIGINT)) AS k) "
    f"SELECT doc_id, k AS window, list_slice(list_slice(ids, 1, len(ids) - 1), k * {T_CTX} + 1, k * {T_CTX} + {T_CTX}) AS x, "
    f"list_slice(ids, k * {T_CTX} + 2, k * {T_CTX} + {T_CTX} + 1) AS y FROM w",
)
def q_next_token_pairs(spark, sf_dir):
    """H7: every window of a text's ids, and the ids that follow each; both have the same length."""
    d = table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", A.char_ids("text").alias("ids")).where(F.size("ids") >= 2)
    n_win = F.ceil((F.size("ids") - 1) / F.lit(T_CTX)).cast("int")
    w = d.select("doc_id", "ids", F.explode(F.sequence(F.lit(0), n_win - 1)).alias("window"))
    start, most = F.col("window") * T_CTX, F.size("ids") - 1
    return w.select(
        "doc_id", "window",
        F.slice("ids", start + 1, F.least(F.lit(T_CTX), most - start)).alias("x"),
        F.slice("ids", start + 2, F.lit(T_CTX)).alias("y"),
    )


@register(
    "cast_long_arrays",
    f"{_IDS_SQL} SELECT row_key, CAST(src_ids AS BIGINT[]) AS src_ids, CAST(tgt_ids AS BIGINT[]) AS tgt_ids FROM ids",
)
def q_cast_long_arrays(spark, sf_dir):
    i = _ids(spark, sf_dir)
    return i.select("row_key", A.as_int64("src_ids").alias("src_ids"), A.as_int64("tgt_ids").alias("tgt_ids"))


# ---- E5 / E6: scoring ----------------------------------------------------------------------------------

_SCORED_SQL = (
    "WITH s AS (SELECT vec_id AS seq_id, CAST(embedding AS DOUBLE[]) AS scores, "
    "((label % len(embedding)) + len(embedding)) % len(embedding) AS target FROM embeddings WHERE len(embedding) > 0)"
)


@register(
    "token_accuracy",
    f"{_SCORED_SQL} SELECT count(*) AS n_tokens, round(avg(CASE WHEN list_position(scores, list_max(scores)) - 1 = target "
    "THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 9) AS token_accuracy FROM s",
)
def q_token_accuracy(spark, sf_dir):
    return EV.token_accuracy(EV.scored_tokens(table(spark, sf_dir, "embeddings")))


@register(
    "mean_nll",
    f"{_SCORED_SQL} SELECT count(*) AS n_tokens, round(avg(ln(list_sum(list_transform(scores, lambda x: exp(x - list_max(scores))))) "
    "+ list_max(scores) - scores[target + 1]), 9) AS mean_nll FROM s",
)
def q_mean_nll(spark, sf_dir):
    return EV.mean_nll(EV.scored_tokens(table(spark, sf_dir, "embeddings")))


# ---- G1-G3: corpus texts, pre-tokens, word counts ----------------------------------------------------------


@register(
    "corpus_texts",
    f"{_CLEAN_SQL} SELECT row_key, 0 AS side, src AS text FROM clean UNION ALL SELECT row_key, 1 AS side, tgt AS text FROM clean",
)
def q_corpus_texts(spark, sf_dir):
    from corpusprep.operators.vocab import corpus_texts

    return corpus_texts(_clean(spark, sf_dir), key="row_key")


@register(
    "pretokenize",
    f"SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, tok AS token FROM documents, unnest({O.pretokens('text')}) WITH ORDINALITY AS t(tok, pos)",
)
def q_pretokenize(spark, sf_dir):
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", F.posexplode(T.pretokens("text")).alias("pos", "token"))


@register(
    "word_freq",
    f"SELECT tok AS word, count(*) AS freq FROM documents, unnest({O.pretokens('text')}) AS t(tok) GROUP BY tok",
)
def q_word_freq(spark, sf_dir):
    from corpusprep.operators.vocab import word_freq

    return word_freq(table(spark, sf_dir, "documents", ["doc_id", "text"]).select("text"), "text")


# ---- A: files, hub, streams -------------------------------------------------------------------------------

from corpusprep.session import delete_path, fs_for, shared_path  # noqa: E402
from corpusprep.sources import jsonl as J  # noqa: E402

_PAIRS_SQL = f"WITH {O.PAIRS} SELECT row_key, src, tgt FROM pairs"


def _nested(df: DataFrame, *keep: str) -> DataFrame:
    return df.select("row_key", *keep, F.struct(F.col("src").alias("en"), F.col("tgt").alias("fr")).alias("translation"))


@register("scan_pairs", _PAIRS_SQL)
def q_scan_pairs(spark, sf_dir):
    """A1: documents written as nested JSON Lines, scanned back with an explicit schema."""
    path = shared_path(spark, "scan_pairs")
    J.write_jsonl_exclusive(_nested(documents_pairs(spark, sf_dir)), path)
    return J.scan_pairs(spark, path, extra=T_ROWKEY)


@register("flatten_translation", _PAIRS_SQL)
def q_flatten_translation(spark, sf_dir):
    """A4: one folder holding both shapes - English documents nested, the others flat."""
    p = documents_pairs(spark, sf_dir)
    nested = F.when(F.col("lang") == "en", F.struct(F.col("src").alias("en"), F.col("tgt").alias("fr")))
    flat_en = F.when(F.col("lang") != "en", F.col("src"))
    flat_fr = F.when(F.col("lang") != "en", F.col("tgt"))
    path = shared_path(spark, "flatten")
    J.write_jsonl_exclusive(p.select("row_key", nested.alias("translation"), flat_en.alias("en"), flat_fr.alias("fr")), path)
    return J.scan_pairs(spark, path, extra=T_ROWKEY)


@register(
    "sink_jsonl_exclusive",
    f"WITH {O.PAIRS}, {O.classified('pairs', 'c')}, s AS (SELECT {O.strip('src')} AS src, {O.strip('tgt')} AS tgt "
    f"FROM c WHERE reason IS NULL) SELECT {O.content_idx('src', 'tgt')} AS idx, src, tgt FROM s",
)
def q_sink_jsonl_exclusive(spark, sf_dir):
    """A2: clean pairs written with create-only semantics and read back."""
    path = shared_path(spark, "sink")
    J.write_jsonl_exclusive(Q.project_clean(Q.filter_valid(_classified(spark, sf_dir))), path)
    return spark.read.schema("idx string, src string, tgt string").json(path)


@register("export_jsonl", ORACLE["sink_jsonl_exclusive"])
def q_export_jsonl(spark, sf_dir):
    """A3: export with ASCII escapes; reading back gives the same strings."""
    path = shared_path(spark, "export")
    J.export_jsonl(Q.project_clean(Q.filter_valid(_classified(spark, sf_dir))), path, ensure_ascii=True)
    return spark.read.schema("idx string, src string, tgt string").json(path)


_SPLIT_SQL = "CASE WHEN CAST(substr(md5(row_key), 1, 1) AS VARCHAR) < '8' THEN 'train' ELSE 'validation' END"


@register(
    "source_by_language_split",
    f"WITH {O.PAIRS}, s AS (SELECT row_key, src, tgt, lang, {_SPLIT_SQL} AS split FROM pairs) "
    "SELECT * FROM s WHERE lang = 'en' UNION ALL SELECT * FROM s WHERE lang = 'fr' AND split = 'validation'",
)
def q_source_by_language_split(spark, sf_dir):
    """A5: documents laid out as a hub dataset (lang / split folders); one language, and one split of another, read back."""
    root = shared_path(spark, "hub")
    split = F.when(F.substring(F.md5("row_key"), 1, 1) < "8", "train").otherwise("validation")
    J.write_hub(_nested(documents_pairs(spark, sf_dir), "lang").withColumn("split", split), root, "documents")
    return J.read_hub(spark, root, "documents", lang="en", extra=T_ROWKEY).union(
        J.read_hub(spark, root, "documents", lang="fr", split="validation", extra=T_ROWKEY))


from pyspark.sql import types as _T  # noqa: E402

T_ROWKEY = _T.StructType([_T.StructField("row_key", _T.StringType())])


STREAM_FILE = 8 << 20  # bytes of the table that an arriving file holds
STREAM_FILES = 12  # most files of a trigger, so that micro-batches don't grow with the input


def _stream_input(spark, sf_dir) -> tuple[str, int]:
    """The pairs as arriving files, 4 or as many as the table's size asks for, and how many of them a trigger takes: a
    fourth, but no more than ``STREAM_FILES``."""
    fs, documents = fs_for(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    files = max(4, -(-fs.getContentSummary(documents).getLength() // STREAM_FILE))
    path = shared_path(spark, "stream_in")
    _nested(documents_pairs(spark, sf_dir)).repartition(files, "row_key").write.json(path)
    return path, min(files // 4, STREAM_FILES)


def _ingested(spark, sf_dir):
    """The documents as arriving files, some files per trigger, ingested."""
    from corpusprep.streaming.ingest import stream_ingest

    path, files = _stream_input(spark, sf_dir)
    ing = stream_ingest(spark, path, shared_path(spark, "stream_out"), shared_path(spark, "stream_ck"), FilterConfig(), max_files_per_trigger=files)
    ing.await_done()
    return ing


@register("stream_ingest", ORACLE["reject_reason"])
def q_stream_ingest(spark, sf_dir):
    """Classified rows of the committed batches."""
    return _ingested(spark, sf_dir).rows().select("row_key", "src_len", "tgt_len", "reason")


@register("stream_totals", ORACLE["reason_counts"])
def q_stream_totals(spark, sf_dir):
    """Running funnel totals after the stream has drained, from the batch log."""
    return _ingested(spark, sf_dir).latest_totals().select("seen", "ok", *Q.REASONS)


@register("buffered_shuffle", _PAIRS_SQL)
def q_buffered_shuffle(spark, sf_dir):
    """B1 on a stream: documents through a bounded-buffer shuffle; what left it and what it still held."""
    from corpusprep.streaming.ingest import drain_shuffle, shuffle_stream, small_batches, stream_pairs

    out, ck = shared_path(spark, "shuffled"), shared_path(spark, "shuffled_ck")
    path, files = _stream_input(spark, sf_dir)
    stream = stream_pairs(spark, path, max_files_per_trigger=files)
    with small_batches(spark):
        q = (shuffle_stream(stream, RawConfig().buffer_size, SEED).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).unionByName(drain_shuffle(spark, ck, stream.schema))


@register("stream_take", f"WITH {O.PAIRS} SELECT least(count(*), {SAMPLE_N}) AS n, least(count(*), {SAMPLE_N}) AS n_of_the_table FROM pairs")
def q_stream_take(spark, sf_dir):
    """The first SAMPLE_N rows of a stream of pairs (order = file arrival order): how many, and how many are rows of the table."""
    from corpusprep.streaming.ingest import stream_pairs, stream_take

    src, files = _stream_input(spark, sf_dir)
    out, ck = shared_path(spark, "take_out"), shared_path(spark, "take_ck")
    q = (
        stream_take(stream_pairs(spark, src, max_files_per_trigger=files), SAMPLE_N)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    known = documents_pairs(spark, sf_dir).select("row_key", "src", "tgt", F.lit(1).alias("known"))
    return spark.read.parquet(out).join(known, ["row_key", "src", "tgt"], "left").agg(
        F.count(F.lit(1)).alias("n"), F.count("known").alias("n_of_the_table"))


# ---- B5, E2b ---------------------------------------------------------------------------------------------


@register(
    "sample_with_replacement",
    f"WITH {O.PAIRS}, r AS (SELECT row_key, row_number() OVER (ORDER BY {O.shuffle_key(SEED, 'row_key')}, row_key) AS position FROM pairs), "
    "n AS (SELECT count(*) AS n FROM pairs), "
    f"d AS (SELECT range AS draw, 1 + ((CAST(('0x' || substr(md5('{SEED}:draw:' || CAST(range AS VARCHAR)), 1, 15)) AS BIGINT) % n.n) + n.n) % n.n AS position "
    "FROM range((SELECT n FROM n)), n) "
    "SELECT d.draw, CAST(d.position AS BIGINT) AS position, r.row_key FROM d JOIN r USING (position)",
)
def q_sample_with_replacement(spark, sf_dir):
    """As many draws as rows (a bootstrap resample of the whole table)."""
    p = documents_pairs(spark, sf_dir).select("row_key")
    n = p.count()
    return S.sample_with_replacement(p, n, SEED).select("draw", "position", "row_key")


@register(
    "series_summary",
    f"WITH {O.PAIRS} SELECT 'seq_len_data' AS key, count(*) AS rows FROM pairs "
    "UNION ALL SELECT 'reject_reasons' AS key, count(*) AS rows FROM pairs",
)
def q_series_summary(spark, sf_dir):
    from corpusprep.operators.profile import SeriesStore

    p = documents_pairs(spark, sf_dir)
    store = SeriesStore(spark, shared_path(spark, "series"))
    store.add("seq_len_data", length_series(p)).add("reject_reasons", p.select("row_key")).add("scratch", p.select("row_key"))
    store.add("reject_reasons", _classified(spark, sf_dir).select("row_key", "reason"))  # in place of the first
    store.remove("scratch")
    return store.info()


@register("series_get", f"WITH {O.PAIRS}, {O.classified('pairs', 'c')} SELECT row_key, reason FROM c")
def q_series_get(spark, sf_dir):
    """One stored series read back."""
    from corpusprep.operators.profile import SeriesStore

    store = SeriesStore(spark, shared_path(spark, "series"))
    store.add("reject_reasons", _classified(spark, sf_dir).select("row_key", "reason")).add("keys", documents_pairs(spark, sf_dir).select("row_key"))
    return store.get("reject_reasons", "row_key string, reason string")


# ---- I / J: catalog and jobs ------------------------------------------------------------------------------

from corpusprep.config import RawConfig, VocabConfig  # noqa: E402
from corpusprep.plans import jobs as JB  # noqa: E402
from corpusprep.plans.catalog import Catalog  # noqa: E402

_STATE: dict = {}


def _catalog_with_jobs(spark, sf_dir) -> tuple[Catalog, str, str]:
    """A catalog in the shared folder holding the raw extraction of the documents view and its
    filtered set (n = FIRST_N)."""
    key = ("catalog", sf_dir, spark.sparkContext.applicationId)
    if key in _STATE:
        return _STATE[key]
    cat = Catalog(spark, shared_path(spark, "catalog"))
    raw = JB.extract_job(documents_pairs(spark, sf_dir), RawConfig(split="train"), cat)
    filt = JB.filter_job(cat, raw.id, n=FIRST_N)
    _STATE[key] = (cat, raw.id, filt.id)
    return _STATE[key]


@register(
    "extract_job",
    f"WITH {O.PAIRS} SELECT row_key, {O.shuffle_key(SEED, 'row_key')} AS skey, src, tgt, "
    f"{O.word_count('src')} AS src_len, {O.word_count('tgt')} AS tgt_len FROM pairs "
    f"ORDER BY skey, row_key LIMIT {RawConfig().n}",
)
def q_extract_job(spark, sf_dir):
    """Seeded sample of the default n (50,000) rows, stored with its lengths."""
    cat, raw_id, _ = _catalog_with_jobs(spark, sf_dir)
    return cat.get(raw_id).rows.select("row_key", "skey", "src", "tgt", "src_len", "tgt_len")


@register(
    "filter_job",
    f"WITH {O.PAIRS}, {O.first_n_window(FIRST_N, SEED)}, s AS (SELECT {O.strip('src')} AS src, {O.strip('tgt')} AS tgt "
    f"FROM win WHERE reason IS NULL) SELECT {O.content_idx('src', 'tgt')} AS idx, src, tgt FROM s",
)
def q_filter_job(spark, sf_dir):
    """The raw set filtered: first FIRST_N valid pairs of the seeded walk as idx, src, tgt."""
    cat, _, filt_id = _catalog_with_jobs(spark, sf_dir)
    return cat.get(filt_id).rows.select("idx", "src", "tgt")


def _registry_sql(stage: str, columns: str) -> str:
    """The registry row of a stage: identity from the configuration, the number of rows from the tables."""
    cfg = RawConfig(split="train") if stage == "raw" else FilterConfig(split="train", n=FIRST_N)
    n = (f"(SELECT least(count(*), {cfg.n}) FROM pairs)" if stage == "raw" else "(SELECT count(*) FROM win WHERE reason IS NULL)")
    text = {c: getattr(cfg, c) for c in ("stage", "split", "lang", "lang_src", "lang_tgt", "source", "source_dataset_name")}
    row = {"id": f"'{cfg.dataset_id}'", "name": f"'{cfg.dataset_name}'", "n": n, **{k: f"'{v}'" for k, v in text.items()}}
    return "SELECT " + ", ".join(f"{row[c]} AS {c}" for c in columns.split())


_REGISTRY = "id name stage split n lang lang_src lang_tgt source source_dataset_name"
_JOBS_SQL = f"WITH {O.PAIRS}, {O.first_n_window(FIRST_N, SEED)} "


@register("catalog_show", f"{_JOBS_SQL}{_registry_sql('raw', _REGISTRY)} UNION ALL {_registry_sql('filtered', _REGISTRY)}")
def q_catalog_show(spark, sf_dir):
    """The registry, from manifests only (its time stamps are checked by ``run_metrics``)."""
    cat, _, _ = _catalog_with_jobs(spark, sf_dir)
    return cat.show().drop("created")


@register("registry_predicate", _JOBS_SQL + _registry_sql("filtered", _REGISTRY))
def q_registry_predicate(spark, sf_dir):
    """Registry filtered by stage and split."""
    cat, _, _ = _catalog_with_jobs(spark, sf_dir)
    return cat.show(stage="filtered", split="train").drop("created")


@register("dataset_info", _JOBS_SQL + _registry_sql("filtered", _REGISTRY.replace(" stage", "")))
def q_dataset_info(spark, sf_dir):
    """The short description of the filtered set."""
    cat, _, filt_id = _catalog_with_jobs(spark, sf_dir)
    return cat.info(filt_id).drop("created")


_FILTERED_SQL = (f"{_JOBS_SQL}, s AS (SELECT {O.strip('src')} AS src, {O.strip('tgt')} AS tgt FROM win WHERE reason IS NULL) "
                 f"SELECT {O.content_idx('src', 'tgt')} AS idx, src, tgt FROM s")


def _second_catalog(spark, sf_dir) -> tuple[Catalog, str]:
    """A new catalog with the filtered set of the first, added as a whole."""
    cat, _, filt_id = _catalog_with_jobs(spark, sf_dir)
    other = Catalog(spark, shared_path(spark, "catalog"))
    other.add(cat.get(filt_id))
    return other, filt_id


@register("catalog_add", _FILTERED_SQL)
def q_catalog_add(spark, sf_dir):
    """A dataset added to another catalog, read there."""
    other, filt_id = _second_catalog(spark, sf_dir)
    return other.read_rows(filt_id).select("idx", "src", "tgt")


@register("catalog_get", f"{_JOBS_SQL}SELECT count(*) AS n, 1 AS found FROM win WHERE reason IS NULL")
def q_catalog_get(spark, sf_dir):
    """A dataset by its id: the stored count and what its rows hold."""
    cat, _, filt_id = _catalog_with_jobs(spark, sf_dir)
    ds = cat.get(filt_id)
    return ds.rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.lit(int(ds.n == ds.count()))).alias("found"))


@register("catalog_remove", "SELECT * FROM (VALUES ('first', TRUE, FALSE), ('again', FALSE, FALSE)) AS t(call, removed, exists_after)")
def q_catalog_remove(spark, sf_dir):
    """Removing a dataset, and removing it again."""
    other, filt_id = _second_catalog(spark, sf_dir)
    rows = [(call, other.remove(filt_id), other.exists(filt_id)) for call in ("first", "again")]
    return spark.createDataFrame(rows, "call string, removed boolean, exists_after boolean")


@register("catalog_exists", "SELECT * FROM (VALUES ('filtered', TRUE), ('raw', TRUE), ('other', FALSE)) AS t(dataset, found)")
def q_catalog_exists(spark, sf_dir):
    """I4: which datasets there are."""
    cat, raw_id, filt_id = _catalog_with_jobs(spark, sf_dir)
    rows = [("filtered", cat.exists(filt_id)), ("raw", cat.exists(raw_id)), ("other", cat.exists("00000000"))]
    return spark.createDataFrame(rows, "dataset string, found boolean")


@register(
    "run_metrics",
    f"{_JOBS_SQL}SELECT 'raw' AS stage, (SELECT least(count(*), {RawConfig().n}) FROM pairs) AS n, CAST(NULL AS BIGINT) AS seen, TRUE AS times_ok "
    "UNION ALL SELECT 'filtered' AS stage, (SELECT count(*) FROM win WHERE reason IS NULL) AS n, (SELECT count(*) FROM win) AS seen, TRUE AS times_ok",
)
def q_run_metrics(spark, sf_dir):
    """Rows and seen rows of both builds, and whether their start, end, duration and throughput agree."""
    cat, _, _ = _catalog_with_jobs(spark, sf_dir)
    get = lambda field, kind: F.get_json_object("metrics", f"$.{field}").cast(kind)
    took = get("ended_at", "timestamp").cast("double") - get("started_at", "timestamp").cast("double")
    rate = F.coalesce(get("seen", "long"), get("n", "long")) / get("duration", "double")
    ok = (F.abs(took - get("duration", "double")) < 0.1) & (F.abs(rate - get("throughput", "double")) < 0.01 * rate + 0.001)
    return cat.manifests().select("stage", get("n", "long").alias("n"), get("seen", "long").alias("seen"), ok.alias("times_ok"))


@register(
    "catalog_audit",
    "SELECT * FROM (VALUES ('rows_without_manifest', 1), ('manifest_without_rows', 1)) AS t(problem, n)",
)
def q_catalog_audit(spark, sf_dir):
    """I4: a catalog with one set that lost its rows and one whose manifest was never written."""
    cat, raw_id, filt_id = _catalog_with_jobs(spark, sf_dir)
    other = Catalog(spark, shared_path(spark, "catalog"))
    other.add(cat.get(filt_id))
    delete_path(spark, other.rows_path(filt_id))
    other.write_rows(raw_id, cat.get(raw_id).rows)
    return other.audit().groupBy("problem").agg(F.count(F.lit(1)).cast("int").alias("n"))


# ---- G4-G7, J3, J4 with a learned vocabulary -----------------------------------------------------------------

def _model(spark, sf_dir):
    """The vocabulary of the filtered corpus, learnt to the end (30,000 tokens, or until pairs are too rare)."""
    key = ("bpe", sf_dir, spark.sparkContext.applicationId)
    if key not in _STATE:
        from corpusprep.operators.vocab import corpus_texts, learn_bpe

        _STATE[key] = learn_bpe(corpus_texts(_clean(spark, sf_dir)), VocabConfig())
    return _STATE[key]


@register(
    "pair_counts",
    f"{_CLEAN_SQL}, w AS (SELECT unnest({O.pretokens('src')}) AS word FROM clean UNION ALL SELECT unnest({O.pretokens('tgt')}) FROM clean), "
    "f AS (SELECT string_split(word, '') AS ch, count(*) AS freq FROM w GROUP BY word), "
    "p AS (SELECT ch, freq, unnest(range(1, len(ch))) AS i FROM f) "
    "SELECT ch[i] AS l, ch[i + 1] AS r, CAST(sum(freq) AS BIGINT) AS cnt FROM p GROUP BY ch[i], ch[i + 1]",
)
def q_pair_counts(spark, sf_dir):
    """The pair counts that learning starts from."""
    from corpusprep.operators.vocab import corpus_texts, pair_counts, word_freq

    return pair_counts(word_freq(corpus_texts(_clean(spark, sf_dir))))


@register("bpe_learn")
def q_bpe_learn(spark, sf_dir):
    """All merges learned from the filtered corpus (exact rules)."""
    return _model(spark, sf_dir).merges_df(spark)


@register("vocab_table")
def q_vocab_table(spark, sf_dir):
    """Token -> id."""
    return _model(spark, sf_dir).vocab_df(spark)


@register(
    "vocab_alphabet",
    f"{_CLEAN_SQL}, w AS (SELECT unnest({O.pretokens('src')}) AS word FROM clean UNION ALL SELECT unnest({O.pretokens('tgt')}) FROM clean), "
    "a AS (SELECT DISTINCT unnest(string_split(word, '')) AS token FROM w) "
    f"SELECT token, CAST({len(VocabConfig().special_tokens)} + row_number() OVER (ORDER BY unicode(token)) - 1 AS INTEGER) AS id FROM a UNION ALL "
    + " UNION ALL ".join(f"SELECT '{t}', {i}" for i, t in enumerate(VocabConfig().special_tokens)),
)
def q_vocab_alphabet(spark, sf_dir):
    """The vocabulary before its merged tokens: special tokens, then characters by code point."""
    m = _model(spark, sf_dir)
    return m.vocab_df(spark).where(F.col("id") < len(m.tokens) - m.made).select("token", "id")


@register("vocab_job")
def q_vocab_job(spark, sf_dir):
    """Filtered set of all valid pairs, in a catalog of its own -> vocabulary saved as tables -> loaded back."""
    from corpusprep.operators.vocab import BpeModel

    cat = Catalog(spark, shared_path(spark, "vocab_catalog"))
    pairs = documents_pairs(spark, sf_dir)
    n = pairs.count()
    raw = JB.extract_job(pairs, RawConfig(split="train", n=n), cat)
    path = shared_path(spark, "vocab")
    JB.vocab_job(cat, JB.filter_job(cat, raw.id, n=n).id, path, VocabConfig())
    return BpeModel.load(spark, path).merges_df(spark)


_SPELLED_SQL = f"{_CLEAN_SQL} SELECT row_key, " + "array_to_string(" + O.pretokens("src") + ", '') AS src_spelled, array_to_string(" + O.pretokens("tgt") + ", '') AS tgt_spelled FROM clean"


@register("encode", _SPELLED_SQL)
def q_encode(spark, sf_dir):
    """Texts of the filtered corpus as ids. The ids' tokens, joined, spell the pre-tokens of the text."""
    from corpusprep.operators.vocab import decode, encode

    m = _model(spark, sf_dir)
    c = _clean(spark, sf_dir).select("row_key", "src", "tgt")
    ids = encode(encode(c, m, "src", "src_ids"), m, "tgt", "tgt_ids")
    spelled = decode(ids, m, ["src_ids", "tgt_ids"], ["src_spelled", "tgt_spelled"])
    return spelled.select("row_key", *(F.replace(c, F.lit(" "), F.lit("")).alias(c) for c in ("src_spelled", "tgt_spelled")))


@register("decode", f"{_CLEAN_SQL} SELECT row_key, array_to_string({O.pretokens('src')}, '') AS src_spelled, array_to_string({O.pretokens('tgt')}, '') AS tgt_spelled, TRUE AS in_vocabulary FROM clean")
def q_decode(spark, sf_dir):
    """Ids of both sides back to space-joined tokens: what they spell, and whether there are as many tokens as ids."""
    from corpusprep.operators.vocab import decode, encode

    m = _model(spark, sf_dir)
    c = encode(encode(_clean(spark, sf_dir).select("row_key", "src", "tgt"), m, "src", "src_ids"), m, "tgt", "tgt_ids")
    d = decode(c, m, ["src_ids", "tgt_ids"], ["src_text", "tgt_text"])
    n = lambda c: F.size(F.filter(F.split(c, " "), lambda x: x != ""))
    spelled = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    return d.select("row_key", spelled("src_text").alias("src_spelled"), spelled("tgt_text").alias("tgt_spelled"),
                    ((n("src_text") == F.size("src_ids")) & (n("tgt_text") == F.size("tgt_ids"))).alias("in_vocabulary"))


_BATCH_SQL = (
    f"{_bucket_sql()} SELECT epoch, batch_index, count(*) AS batch_rows, count(*) * {L_SEQ} AS n_encoder, count(*) * {L_SEQ} AS n_labels, "
    "TRUE AS starts_and_ends, TRUE AS masks_agree FROM bb GROUP BY epoch, batch_index"
)


@register("batch_job", _BATCH_SQL)
def q_batch_job(spark, sf_dir):
    """Filtered corpus -> BPE ids -> length buckets -> collated, packed batches: their layout, sizes, first
    and last tokens and masks."""
    m = _model(spark, sf_dir)
    b = JB.batch_job(_clean(spark, sf_dir).select("row_key", "src", "tgt"), m, batch_size=BATCH, bucket_width=WIDTH, l_src=L_SEQ, l_tgt=L_SEQ)
    first = F.forall("decoder_input_ids", lambda x: F.element_at(x, 1) == m.token_id("<BOS>"))
    last = F.forall("labels", lambda x: F.element_at(x, -1) == m.token_id("<EOS>"))
    same = F.transform("encoder_input_ids", lambda x: F.transform(x, lambda i: i != m.token_id("<PAD>"))) == F.col("encoder_attn_mask")
    n = lambda c: F.aggregate(F.col(c), F.lit(0).cast("long"), lambda a, x: a + F.size(x))
    return b.select(F.col("epoch").cast("int").alias("epoch"), F.col("batch_index").cast("long").alias("batch_index"), F.col("batch_rows").cast("long").alias("batch_rows"),
                    n("encoder_input_ids").alias("n_encoder"), n("labels").alias("n_labels"), (first & last).alias("starts_and_ends"), same.alias("masks_agree"))
