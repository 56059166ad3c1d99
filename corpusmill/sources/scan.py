"""Scan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# compressed input per partition when a coarse scan is spread (text work is CPU-heavy per byte)
SPREAD_BYTES_PER_PARTITION = 1 << 20


def _estimated_bytes(df: DataFrame) -> int | None:
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v) if isinstance(v, int) else int(v.toString())
    except Exception:  # noqa: BLE001 - statistics are an optimisation only
        return None


def spread(df: DataFrame, key: str | None, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition a scan by ``key`` when it arrives in fewer partitions than
    the cluster has cores.

    A parquet file with a single row group is read by a single task, and all the
    per-row text work before the first shuffle would then run in that task.
    Large inputs already arrive in many splits and are returned unchanged, so
    this never adds a shuffle at scale.  The target is capped by the scan's
    estimated size (about one partition per MB of compressed input) so a small
    table is not cut into thousands of empty tasks on a large cluster.  Hashing
    on a key keeps retries deterministic (a round-robin repartition would not be).
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    size = _estimated_bytes(df)
    if size is not None:
        target = max(1, min(target, -(-size // SPREAD_BYTES_PER_PARTITION)))
    if key is None or df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, F.col(key))
