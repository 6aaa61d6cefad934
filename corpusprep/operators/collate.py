"""Collation into training batches (H1-H6).

Per row: truncate/pad the encoder ids, build decoder input and labels from the padded target,
and the two attention masks. Per batch (H6): one row per batch with the rows stacked in their
in-batch position - a ``groupBy(batch)`` whose groups are bounded by ``batch_size``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.functions import arrays as A

# Special-token ids of the deployed vocabulary (<PAD> <UNK> <BOS> <EOS> <MASK>).
PAD_ID, UNK_ID, BOS_ID, EOS_ID, MASK_ID = 0, 1, 2, 3, 4


def collate_rows(df: DataFrame, src_ids: str = "src_ids", tgt_ids: str = "tgt_ids", l_src: int = 64,
                 l_tgt: int = 64, pad_id: int = PAD_ID, bos_id: int = BOS_ID, eos_id: int = EOS_ID,
                 eos: str = "after_padding") -> DataFrame:
    """H1-H4 per row: ``encoder_input_ids, decoder_input_ids, labels, encoder_attn_mask,
    decoder_attn_mask`` (int32 / boolean arrays)."""
    enc = A.pad_truncate(src_ids, l_src, pad_id)
    tgt = A.pad_truncate(tgt_ids, l_tgt, pad_id)
    dec = A.decoder_input(tgt, l_tgt, bos_id)
    if eos == "after_padding":
        lab = A.labels(tgt, l_tgt, eos_id)
    elif eos == "after_text":
        lab = A.labels_eos_after_text(tgt_ids, l_tgt, pad_id, eos_id)
    else:
        raise ValueError("eos must be 'after_padding' or 'after_text'")
    keep = [c for c in df.columns if c not in (src_ids, tgt_ids)]
    return df.select(
        *keep,
        A.as_int32(enc).alias("encoder_input_ids"),
        A.as_int32(dec).alias("decoder_input_ids"),
        A.as_int32(lab).alias("labels"),
        A.attention_mask(enc, pad_id).alias("encoder_attn_mask"),
        A.attention_mask(dec, pad_id).alias("decoder_attn_mask"),
    )


def pad_to_batch_max(df: DataFrame, col: str, batch_cols: list[str], pad_id: int = PAD_ID, out: str | None = None) -> DataFrame:
    """H5: pad ``col`` to the longest row of its batch (groups are bounded by the batch size)."""
    w = Window.partitionBy(*batch_cols)
    return df.withColumn(out or col, A.pad_to(col, F.max(F.size(col)).over(w), pad_id))


def _field_getter(name: str):
    return lambda r: r[name]


BATCH_FIELDS = ["encoder_input_ids", "decoder_input_ids", "labels", "encoder_attn_mask", "decoder_attn_mask"]


def pack_batches(rows: DataFrame, batch_cols: list[str], pos: str = "pos", pad_id: int = PAD_ID,
                 fields: list[str] = BATCH_FIELDS) -> DataFrame:
    """H6: one row per batch; each field becomes ``array<array<..>>`` ordered by in-batch position."""
    packed = rows.groupBy(*batch_cols).agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos).alias("_p"), *[F.col(f) for f in fields]))).alias("_rows"),
        F.count(F.lit(1)).alias("batch_rows"),
    )
    return packed.select(
        *batch_cols,
        "batch_rows",
        *[F.transform("_rows", _field_getter(f)).alias(f) for f in fields],
        F.lit(pad_id).alias("pad_id"),
    )
