"""Inputs derived from the given tables, built identically in Spark and in SQL.

``documents`` is clean text, so the corpus-normaliser queries inject dirt
deterministically (decomposed accents, tab + NBSP runs, control characters)
before normalising; the SQL side in ``sql.py`` injects the same dirt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import text as text_ops
from ..operators.vocab import build_vocab, word_table
from ..sources.scan import spread

# Fixed values of the dirt injection (applied in Spark and SQL alike):
#   doc_id % 5 = 0  : 'é' (U+00E9) -> 'e' + U+0301 (combining acute accent)
#   doc_id % 7 = 0  : every ' ' -> TAB + U+00A0 + ' '
#   doc_id % 11 = 0 : U+0001 + U+000D inserted after the 10th character
DECOMPOSED_E = "e\u0301"
SPACE_DIRT = "\t\u00a0 "
CONTROL_DIRT = "\u0001\r"
SEQ_LEN = 64
BLOCK = 32
BATCH_SIZE = 16
SEED = 42


# key column used to spread each table when its scan is too coarse
TABLE_KEYS = {"documents": "doc_id", "conversations": "conv_id", "events": "event_id",
              "pages": "page_id", "labels": "doc_id", "benchmark": "item_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TABLE_KEYS.get(name))


def dirty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _dirty(d: DataFrame) -> DataFrame:
    t1 = F.when(F.col("doc_id") % 5 == 0, F.replace("text", F.lit("\u00e9"), F.lit(DECOMPOSED_E))
                ).otherwise(F.col("text"))
    d = d.withColumn("text", t1)
    t2 = F.when(F.col("doc_id") % 7 == 0, F.replace("text", F.lit(" "), F.lit(SPACE_DIRT))
                ).otherwise(F.col("text"))
    d = d.withColumn("text", t2)
    t3 = F.when(F.col("doc_id") % 11 == 0,
                F.concat(F.substring("text", 1, 10), F.lit(CONTROL_DIRT),
                         F.expr("substring(text, 11)"))).otherwise(F.col("text"))
    return d.withColumn("text", t3)


def normalized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_ops.normalize_corpus(dirty_documents(spark, sf_dir))


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_ops.min_length_filter(normalized_documents(spark, sf_dir))


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line_no, line)``: the cleaned corpus as the downstream stages read it."""
    return text_ops.explode_lines(clean_documents(spark, sf_dir))


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocab(word_table(corpus_lines(spark, sf_dir), "line"))


def wrapped_from(tokens: DataFrame) -> DataFrame:
    """``[BOS] + ids + [EOS]`` per non-blank line, as the LM datasets build them."""
    from ..operators.tokenize import SPECIALS, wrap_special
    toks = tokens.filter(F.size("ids") > 0)
    return toks.withColumn("ids", wrap_special("ids", SPECIALS.bos, SPECIALS.eos))


__all__ = ["table", "dirty_documents", "normalized_documents", "clean_documents",
           "corpus_lines", "vocab", "wrapped_from"]
