"""Labelled rows for the trained operators: held-out rule and a bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialize

FOLDS, HELD_OUT = 3, 1


def held_out(id_col: str = "doc_id") -> Column:
    """True for ids whose crc32 (of the id as text) mod 3 is 1; a null id is held out."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, text, y``: at most ``max_rows`` labelled rows that are not held out (null labels left out).

    The rows are those with the smallest hashes of their ids, a fixed sample.  The ids go to
    every task; there are ``max_rows`` of them at most.
    """
    rows = labels.filter(F.col(label).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    rows = rows.dropDuplicates(["id"]).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return materialize(texts.join(F.broadcast(rows), "id"), f"train-{label}")
