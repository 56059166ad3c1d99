"""Sequence construction: packing, chunking, truncation, shifting, padding.

Everything except ``pack`` is a per-row array expression (no shuffle).
``pack`` needs the global token offset of each record, computed with the
three-level prefix sum; each record then emits only the slices that fall into
each fixed-length block, and a block is regrouped from at most ``seq_len``
tokens -- a giant document spreads over many blocks, never one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import prefix_sum
from .vocab import EOS_ID, PAD_ID


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pack(tokens: DataFrame, seq_len: int = 4096, eos: int = EOS_ID, ids_col: str = "ids",
         order_cols=("doc_id", "line_no"), line_width: int = 4096, doc_group: int = 65536) -> DataFrame:
    """Concatenate ``ids + [eos]`` of all records in order and cut into ``seq_len`` blocks.

    Blocks cross record boundaries; the final partial block is dropped; a blank
    record contributes a lone EOS.  Output ``(seq_id, input_ids int[], attention_mask tinyint[])``.

    Offsets come from the three-level prefix sum with buckets (document, line
    range of ``line_width``) -- a document holding a third of all lines is
    split by line range -- and coarse buckets of ``doc_group`` documents, the
    only table broadcast.
    """
    doc, line = order_cols
    rec = tokens.select(doc, line, F.concat(_c(ids_col), F.array(F.lit(eos))).cast("array<int>")
                        .alias("__t"))
    rec = rec.withColumn("__n", F.size("__t").cast("long"))
    bucket = [F.col(doc), F.floor(F.col(line) / line_width)]
    rec = prefix_sum(rec, [doc, line], bucket, "__n", "__start",
                     coarse=F.floor(F.col("__b0") / doc_group))
    L = F.lit(seq_len).cast("long")
    rec = rec.withColumn("__end", F.col("__start") + F.col("__n"))
    blocks = F.sequence(F.floor(F.col("__start") / L), F.floor((F.col("__end") - 1) / L))
    seg = rec.select("__t", "__start", "__end", F.explode(blocks).alias("seq_id"))
    s0 = F.greatest(F.col("__start"), F.col("seq_id") * L)
    s1 = F.least(F.col("__end"), (F.col("seq_id") + 1) * L)
    seg = seg.select("seq_id", s0.alias("__s"),
                     F.slice("__t", (s0 - F.col("__start") + 1).cast("int"), (s1 - s0).cast("int"))
                     .alias("__seg"))
    seqs = seg.groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct("__s", "__seg"))).alias("__p"))
    ids = F.flatten(F.transform("__p", lambda x: x["__seg"]))
    out = seqs.select("seq_id", ids.alias("input_ids")).filter(F.size("input_ids") == seq_len)
    return out.withColumn("attention_mask", F.array_repeat(F.lit(1).cast("tinyint"), seq_len))


def chunk(ids, block: int) -> Column:
    """Chunk starts ``range(0, n - block, block)``, each chunk ``block + 1`` ids."""
    n = F.size(_c(ids))
    starts = F.when(n > block, F.sequence(F.lit(0), n - block - 1, F.lit(block))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(_c(ids), s + 1, block + 1))


def chunk_lines(tokens: DataFrame, block: int, key_cols=("doc_id", "line_no"),
                ids_col: str = "ids") -> DataFrame:
    """One row per chunk: ``(*key_cols, chunk_no, ids)``; lines of ``<= block`` ids give none."""
    ex = tokens.select(*key_cols, F.posexplode(chunk(ids_col, block)).alias("chunk_no", "ids"))
    return ex.withColumn("chunk_no", F.col("chunk_no").cast("long"))


def truncate(ids, block: int) -> Column:
    """``ids[:block]``."""
    return F.slice(_c(ids), 1, block)


def truncate_left(ids, block: int) -> Column:
    """``ids[-block:]``: keep the last ``block`` ids."""
    c = _c(ids)
    return F.when(F.size(c) > block, F.slice(c, -block, block)).otherwise(c)


def shift_x(ids) -> Column:
    c = _c(ids)
    return F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))


def shift_y(ids) -> Column:
    c = _c(ids)
    return F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))


def pad_to(ids, length, pad: int = PAD_ID) -> Column:
    """Right-pad to ``length`` (an int or a column); longer arrays are left as they are."""
    c = _c(ids)
    ln = F.lit(length) if isinstance(length, int) else _c(length)
    return F.concat(c, F.array_repeat(F.lit(pad), F.greatest(ln - F.size(c), F.lit(0))).cast(
        "array<int>"))


def attention_mask(ids, pad: int = PAD_ID) -> Column:
    """``x != PAD`` as tinyint."""
    return F.transform(_c(ids), lambda t: (t != F.lit(pad)).cast("tinyint"))


def seq_length_filter(df: DataFrame, ids_col: str = "ids", block: int | None = None) -> DataFrame:
    """Keep ``1 < len <= block`` (``1 < len`` when block is None)."""
    n = F.size(ids_col)
    cond = n > 1 if block is None else (n > 1) & (n <= block)
    return df.filter(cond)


def pad_fixed(df: DataFrame, block: int, ids_col: str = "ids", pad: int = PAD_ID) -> DataFrame:
    """Truncate to ``block`` then right-pad with PAD to exactly ``block``."""
    return df.withColumn(ids_col, pad_to(truncate(ids_col, block), block, pad))


def pad_dynamic(df: DataFrame, batch_col: str = "batch_id", x_col: str = "x", y_col: str = "y",
                pad: int = PAD_ID) -> DataFrame:
    """Pad ``x`` and ``y`` to the longest ``x`` of each batch; add the PAD mask.

    The batch maximum is a per-batch aggregate joined back; batches are bounded
    by the batch size, so the join never concentrates a large group.
    """
    longest = df.groupBy(batch_col).agg(F.max(F.size(x_col)).alias("__max"))
    d = df.join(longest, batch_col)
    d = d.withColumn(x_col, pad_to(x_col, F.col("__max"), pad)).withColumn(
        y_col, pad_to(y_col, F.col("__max"), pad))
    return d.withColumn("attention_mask", attention_mask(x_col, pad)).drop("__max")


def padding_waste(lengths: DataFrame, len_col: str, batch_col: str, block: int,
                  seq_len: int) -> DataFrame:
    """Pad share of fixed (to ``block``), dynamic (to batch max) and packed layouts.

    ``(policy, n_tokens, n_slots, n_pad)`` -- counts only, so the result is exact.
    """
    n = F.least(F.col(len_col), F.lit(block)).cast("long")
    fixed = lengths.agg(F.sum(n).alias("t"), (F.count("*") * block).cast("long").alias("s"))
    per_batch = lengths.groupBy(batch_col).agg(F.sum(n).alias("t"), F.count("*").alias("c"),
                                               F.max(n).alias("m"))
    dynamic = per_batch.agg(F.sum("t").alias("t"), F.sum(F.col("c") * F.col("m")).alias("s"))
    raw = F.col(len_col).cast("long")
    packed = lengths.agg(F.sum(raw).alias("t")).select(
        "t", (F.floor(F.col("t") / seq_len) * seq_len + F.when(F.col("t") % seq_len > 0, seq_len)
              .otherwise(0)).alias("s"))
    parts = [fixed.select(F.lit("fixed").alias("policy"), "t", "s"),
             dynamic.select(F.lit("dynamic").alias("policy"), "t", "s"),
             packed.select(F.lit("packed").alias("policy"), "t", "s")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.select("policy", F.col("t").cast("long").alias("n_tokens"),
                    F.col("s").cast("long").alias("n_slots"),
                    (F.col("s") - F.col("t")).cast("long").alias("n_pad"))


__all__ = ["pack", "chunk", "chunk_lines", "truncate", "truncate_left", "shift_x", "shift_y",
           "pad_to", "attention_mask", "seq_length_filter", "pad_fixed", "pad_dynamic",
           "padding_waste", "count_non_pad"]


def count_non_pad(ids, pad: int = PAD_ID) -> Column:
    """Number of positions that are not PAD (the targets a loss counts)."""
    return F.size(F.filter(_c(ids), lambda t: t != F.lit(pad))).cast("long")
