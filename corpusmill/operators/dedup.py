"""Exact deduplication.

The first copy in input order wins and the original (unstripped) text is kept.
The smallest order key of each content key is found by a hash aggregate over
fixed-width values (never the text): Spark combines map-side, so a key held by a third
of all rows collapses to one row per task before the shuffle -- no window, no sort of
the hot group.  A semi-join on the order key then keeps the winning rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def _key_cols(text_col: str):
    stripped = T.py_strip(text_col)
    # sha2 of the stripped text plus its length: a collision would need both to agree; a null text is a key of its own
    return [F.coalesce(F.sha2(stripped, 256), F.lit("")).alias("__h"), F.coalesce(F.length(stripped), F.lit(-1)).alias("__n")]


_SHORT = ("tinyint", "smallint", "int")


def _order_key(df: DataFrame, order_cols: Sequence[str]) -> Column:
    """One value that sorts as ``order_cols``; two integers become one decimal, whose minimum a
    hash aggregate can keep (the minimum of a struct would plan a sort aggregate)."""
    types = dict(df.dtypes)
    if len(order_cols) == 1:
        return F.col(order_cols[0])
    if len(order_cols) == 2 and types[order_cols[0]] in (*_SHORT, "bigint") and types[order_cols[1]] in _SHORT:
        high, low = (F.col(c).cast("decimal(19,0)") for c in order_cols)
        # 32 bits for the second number, shifted to be positive
        return (high * F.lit(Decimal(2**32)) + low + F.lit(Decimal(2**31))).cast("decimal(38,0)")
    return F.struct(*[F.col(c) for c in order_cols])


def dedup_first(df: DataFrame, order_cols: Sequence[str], text_col: str = "text") -> DataFrame:
    """Keep the first row (by ``order_cols``) of every distinct stripped text.

    A text always keeps exactly one row: rows without an order value lose against the others, and of rows
    that repeat text and order (or have none) one stays.  Those are reduced to one a task before the
    shuffle, and the join is on text and order together, so no hot text or order value is in one task.
    """
    order = list(order_cols)
    first = df.select(*_key_cols(text_col), _order_key(df, order).alias("__o")).groupBy("__h", "__n").agg(F.min("__o").alias("__o"))
    # a struct around the order value is equal to another one also where the value is null
    key = ["__h", "__n", "__k"]
    first = first.select("__h", "__n", F.struct("__o").alias("__k"))
    h, n = _key_cols(text_col)
    rows = df.select("*", h, n, F.struct(_order_key(df, order).alias("__o")).alias("__k"))
    one = Window.partitionBy(*key).orderBy("__n")
    rows = rows.withColumn("__r", F.row_number().over(one)).filter("__r = 1").drop("__r")
    kept = rows.join(first, key, "left_semi")
    return kept.select(*order, *[c for c in df.columns if c not in order])


def dedup_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: records in, distinct records out, removed copies, duplicated keys, largest group."""
    groups = df.select(*_key_cols(text_col)).groupBy("__h", "__n").agg(F.count("*").alias("c"))
    return groups.agg(
        F.sum("c").cast("long").alias("n_in"),
        F.count("*").cast("long").alias("n_out"),
        (F.sum("c") - F.count("*")).cast("long").alias("n_removed"),
        F.count(F.when(F.col("c") > 1, 1)).cast("long").alias("n_dup_keys"),
        F.max("c").cast("long").alias("max_copies"),
    )
