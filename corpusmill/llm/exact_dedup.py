"""Exact duplicates by a tree merge of sorted digest runs (DataFrame operations only).

1. Every row gets a run number from a hash of its id, so copies of one text are
   dealt over all runs.  A run holds, sorted by digest, one entry per text: SHA-256,
   the fields that verify it, the winning id and the number of rows.
2. Rounds of a binomial tree: run ``r`` goes to run ``r div fan_in``, where up to
   ``fan_in`` runs are merged; entries with the same digest *and* the same
   verification fields become one entry with the winning id.  A text with any number
   of copies contributes at most one entry per run to a round.
3. The result of the root goes back down the same tree, so that no join ever sees
   more than ``fan_in`` rows of one key, however many copies a text has.

Verification: entries merge only if byte length and an independent 64-bit hash agree
as well as the digest; entries whose digests collide stay apart at every level.

Nulls and edge cases: a null text counts as the empty text; a null id loses against
any other id (``keep_id`` is null only if all ids of the group are null); rows that
repeat an id and a text are one winner and otherwise dropped rows; an empty table
gives an empty result.  Input columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialize

ENTRY = ["digest", "n_bytes", "check"]


def with_digest(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``digest`` (SHA-256, 32 bytes), ``n_bytes`` and ``check`` of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"digest": F.unhex(F.sha2(text, 256)), "n_bytes": F.octet_length(text),
                             "check": F.xxhash64(text)})


def tree_merge_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 64,
                     fan_in: int = 8, keep: str = "max") -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, digest``.

    ``keep`` is ``max`` or ``min``: which id of equal texts wins.
    """
    best = {"max": F.max, "min": F.min}[keep]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = with_digest(rows).select("id", *ENTRY, F.pmod(F.xxhash64("id"), F.lit(runs)).alias("run"))
    # repeated (id, text) rows collapse here; the copies of one text stay spread over the runs
    leaves = materialize(rows.groupBy("run", *ENTRY, "id").agg(F.count("*").alias("n"))
                         .sortWithinPartitions("run", "digest"), "digest-leaves")
    level = leaves.groupBy("run", *ENTRY).agg(best("id").alias("keep_id"), F.sum("n").alias("group_size"))
    levels, width = [], runs
    while True:
        level = materialize(level.sortWithinPartitions("run", "digest"), "digest-runs")
        levels.append(level)
        if width == 1:
            break
        width = -(-width // fan_in)
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in)).groupBy("run", *ENTRY)
                 .agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    verdict = levels.pop()
    while levels:  # from the root back to the leaves
        up = verdict.withColumnRenamed("run", "up")
        down = levels.pop().select("run", *ENTRY, F.floor(F.col("run") / fan_in).alias("up"))
        verdict = down.join(up, ["up", *ENTRY]).drop("up")
    out = leaves.join(verdict, ["run", *ENTRY])
    # a repeated (id, text) row wins once
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return out.select("id", "keep_id", "group_size",
                      (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`tree_merge_dedup` keeps, with all their columns.

    Of rows that repeat an id and a text with different other columns any one stays.
    """
    from pyspark.sql import Window
    winners = tree_merge_dedup(docs, id_col, text_col).filter("kept").select(
        F.col("id").alias("__id"), F.col("digest").alias("__digest"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn("__d", F.unhex(F.sha2(text, 256)))
    kept = keyed.join(winners, keyed[id_col].eqNullSafe(winners["__id"]) & (keyed["__d"] == winners["__digest"]),
                      "left_semi")
    one = Window.partitionBy(id_col, "__d").orderBy("__d")
    return (kept.withColumn("__copy", F.row_number().over(one)).filter("__copy = 1").drop("__copy", "__d"))


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = tree_merge_dedup(docs)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
