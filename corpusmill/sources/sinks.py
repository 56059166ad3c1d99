"""Sinks: text, packed parquet with a row count, vocabulary.

Intermediate outputs go under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/corpusmill-{name}-{uuid.uuid4().hex}"


def write_text(df: DataFrame, path: str, text_col: str = "text", order_cols=None,
               mode: str = "error") -> None:
    """One record per line (S8).  With ``order_cols`` the files are range-partitioned
    and sorted so that reading ``part-*`` in name order gives the input order."""
    out = df
    if order_cols:
        out = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    out.select(F.col(text_col).alias("value")).write.mode(mode).text(path)


def write_packed(df: DataFrame, path: str, mode: str = "error") -> int:
    """Packed sequences as parquet (``input_ids int[]``, ``attention_mask tinyint[]``).

    Returns the number of rows written, counted by an observation during the
    write itself rather than by a second pass.
    """
    obs = Observation("packed_rows")
    out = df.select(F.col("input_ids").cast("array<int>").alias("input_ids"),
                    F.col("attention_mask").cast("array<tinyint>").alias("attention_mask"))
    out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return int(obs.get["rows"])


def write_vocab(vocab: DataFrame, path: str, mode: str = "error") -> None:
    """The vocabulary artefact ``(piece, id, score)`` as parquet."""
    v = vocab.select("piece", F.col("id").cast("int").alias("id"),
                     F.col("count").cast("double").alias("score"))
    v.write.mode(mode).parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("piece", "id", F.col("score").cast("long").alias("count"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table under the shared checkpoint
    folder and reading it back.

    Unlike ``DataFrame.checkpoint`` (which computes the plan once for its count
    and again for the checkpoint write unless cached), the plan runs exactly
    once, the data is stored columnar and compressed, and a lost executor only
    costs re-reading files, never recomputing the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def write_shards(df: DataFrame, path: str, rank_col: str = "rank", mode: str = "error",
                 order_cols: Sequence[str] = ()) -> None:
    """One folder per process rank (``rank=<r>``), so each trainer reads only its
    own shard through partition pruning (B6).

    Rows are range-partitioned by rank and ``order_cols`` (batch, position), so a rank's files hold
    consecutive, sorted batches and a task writes to few ranks.
    """
    keys = [rank_col, *order_cols]
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out.write.mode(mode).partitionBy(rank_col).parquet(path)
