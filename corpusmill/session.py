"""Spark session helpers.

Library code never creates its own session: every operator takes a DataFrame
and returns a DataFrame.  These helpers exist for tests, the bench and the
query catalog, which need a session configured the same way every time.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "corpusmill") -> SparkSession:
    """A session tuned for the operators in this package.

    AQE is on so that joins against derived tables (vocabularies, candidate
    tables) are re-planned from real shuffle sizes, skewed partitions are split
    and small shuffle partitions are coalesced.
    """
    master = master or os.environ.get("CORPUSMILL_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CORPUSMILL_DRIVER_MEMORY", "16g"))
    )
    # extra settings for local diagnostics, e.g. CORPUSMILL_CONF="spark.eventLog.enabled=true"
    for item in filter(None, os.environ.get("CORPUSMILL_CONF", "").split(",")):
        k, _, v = item.partition("=")
        builder = builder.config(k.strip(), v.strip())
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is left as
    it is; without that setting this raises, because a machine-local folder
    would not be seen by the other executors.  Only single-process local runs
    (tests, bench) get a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="corpusmill-ckpt-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used for checkpoints and materialised intermediates."""
    return ensure_checkpoint_dir(spark)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run over ``input_bytes`` of input on ``total_cores`` cores.

    Shuffle partitions are sized so that a partition of the largest shuffle
    (about the input size: the exploded token tables and the cleaned corpus
    are of that order) stays near ``target_partition_bytes``, and never fewer
    than 2 waves of tasks; AQE then coalesces small partitions and splits
    skewed ones at runtime.  For 100 TB on 8,000 cores this gives ~400k
    partitions of ~256 MB.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
