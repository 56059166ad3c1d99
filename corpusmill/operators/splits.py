"""Exact, reproducible splits, shuffles, batches and shards.

Randomness is a seeded hash of the row key, never ``rand()``: a retried task
or a re-run gives the same assignment.  Positions come from the three-level
global rank, so no step funnels the data through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import global_rank, hash_bucket


def seeded_key(key_cols, *salt) -> Column:
    """``md5('k1:k2:...:salt...')`` -- a uniform, reproducible sort key."""
    parts = [F.col(c).cast("string") for c in key_cols] + [F.lit(str(s)) for s in salt]
    return F.md5(F.concat_ws(":", *parts))


def shuffled_rank(df: DataFrame, key_cols, *salt, out: str = "position") -> DataFrame:
    """1-based position in the seeded pseudo-random order."""
    d = df.withColumn("__k", seeded_key(key_cols, *salt))
    ranked = global_rank(d, [F.col("__k")] + [F.col(c) for c in key_cols], hash_bucket("__k", 5), out)
    return ranked.drop("__k")


def train_val_split(df: DataFrame, key_cols, train_fraction: float = 0.95, seed: int = 42,
                    out: str = "split") -> DataFrame:
    """Exactly ``int(train_fraction * n)`` rows get ``train``, the rest ``val`` (B1).

    ``n`` is one scalar computed by an aggregate; ``randomSplit`` would not be exact.
    """
    n = df.count()
    n_train = int(train_fraction * n)
    ranked = shuffled_rank(df, key_cols, seed, out="__pos")
    return ranked.withColumn(out, F.when(F.col("__pos") <= n_train, "train").otherwise("val")).drop("__pos")


def epoch_shuffle(df: DataFrame, key_cols, epochs, seed: int = 42) -> DataFrame:
    """One row per (row, epoch) with its 1-based ``position`` in that epoch's order (B2)."""
    ep = df.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in epochs])))
    d = ep.withColumn("__k", F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols],
                                               F.lit(str(seed)), F.col("epoch").cast("string"))))
    ranked = global_rank(d, [F.col("__k")] + [F.col(c) for c in key_cols], hash_bucket("__k", 5),
                         "position", partition_by=["epoch"])
    return ranked.drop("__k")


def assign_batches(df: DataFrame, batch_size: int, position_col: str = "position",
                   out: str = "batch_id") -> DataFrame:
    """Consecutive positions form a batch; the last partial batch is kept."""
    return df.withColumn(out, F.floor((F.col(position_col) - 1) / batch_size).cast("long"))


def drop_last(df: DataFrame, n_rows: int, batch_size: int, batch_col: str = "batch_id") -> DataFrame:
    """Discard the partial final batch."""
    return df.filter(F.col(batch_col) < n_rows // batch_size)


def batch_plan(df: DataFrame, batch_size: int, epochs: int, grad_accum: int,
               group_cols=()) -> DataFrame:
    """Loader length and optimizer steps (B5): ``ceil`` as the reference reports it,
    ``floor`` as many batches as a drop-last loader really yields."""
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    agg = g.agg(F.count("*").cast("long").alias("n_rows"))
    ceil_b = F.ceil(F.col("n_rows") / batch_size).cast("long")
    floor_b = F.floor(F.col("n_rows") / batch_size).cast("long")
    return agg.select(*group_cols, "n_rows", ceil_b.alias("batches_ceil"), floor_b.alias("batches_floor"),
                      F.floor(ceil_b * epochs / grad_accum).cast("long").alias("optimizer_steps_ref"),
                      F.floor(floor_b * epochs / grad_accum).cast("long").alias("optimizer_steps"))


def shard_batches(df: DataFrame, world_size: int, batch_col: str = "batch_id",
                  out: str = "rank") -> DataFrame:
    """Round-robin batches over ``world_size`` processes (B6); write with ``partitionBy(out)``."""
    return df.withColumn(out, F.pmod(F.col(batch_col), F.lit(world_size)).cast("int"))
