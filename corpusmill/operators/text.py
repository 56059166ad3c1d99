"""Record- and line-level text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def normalize_corpus(df: DataFrame, text_col: str = "text", out: str | None = None) -> DataFrame:
    """Apply the corpus normaliser (NFC, tab, space runs, controls, strip) in one projection."""
    return df.withColumn(out or text_col, T.normalize_text(text_col))


def min_length_filter(df: DataFrame, text_col: str = "text", min_chars: int = T.MIN_CHARS) -> DataFrame:
    """Keep records with at least ``min_chars`` code points (per record, not per line)."""
    return df.filter(F.length(text_col) >= min_chars)


def prepare_corpus(df: DataFrame, text_col: str = "text", min_chars: int = T.MIN_CHARS) -> DataFrame:
    """Normalise then length-filter: the cleaned-corpus stage."""
    return min_length_filter(normalize_corpus(df, text_col), text_col, min_chars)


def explode_lines(df: DataFrame, key_cols=("doc_id",), text_col: str = "text",
                  out: str = "line") -> DataFrame:
    """One row per ``\\n``-separated line, keyed ``(*key_cols, line_no)``.

    The cleaned text keeps embedded newlines and the reference writes it as a
    text file that later stages read line by line, so a multi-line record
    becomes several downstream records.
    """
    ex = df.select(*key_cols, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", out))
    return ex.withColumn("line_no", F.col("line_no").cast("long"))


def split_lines(df: DataFrame, key_cols=("doc_id",), text_col: str = "text",
                out: str = "line") -> DataFrame:
    """``str.splitlines()`` semantics (all Unicode line breaks), keyed ``line_no``."""
    ex = df.select(*key_cols, F.posexplode(T.split_lines(text_col)).alias("line_no", out))
    return ex.withColumn("line_no", F.col("line_no").cast("long"))


def clean_lines(df: DataFrame, key_cols=("doc_id",), text_col: str = "text",
                out: str = "line") -> DataFrame:
    """NFKC -> splitlines -> rstrip -> drop blank lines (tokenizer-training input)."""
    lines = split_lines(df.withColumn(text_col, T.nfkc(text_col)), key_cols, text_col, out)
    return lines.withColumn(out, T.py_rstrip(out)).filter(~T.is_blank(out))


def redact(df: DataFrame, text_col: str = "text", out: str | None = None) -> DataFrame:
    """E-mail then phone redaction."""
    return df.withColumn(out or text_col, T.redact_pii(text_col))


def word_counts(df: DataFrame, text_col: str = "text", out: str = "n_words") -> DataFrame:
    return df.withColumn(out, T.word_count(text_col).cast("long"))


def line_index(lines: DataFrame, order_cols=("doc_id", "line_no"), out: str = "line_index",
               line_width: int = 4096, doc_group: int = 65536) -> DataFrame:
    """0-based position of every line in corpus order (the index a line-by-line
    reader sees; blank lines take an index too).  Three-level global rank with
    buckets (document, line range), so a huge document is split."""
    from .ordering import prefix_sum
    doc, line = order_cols
    bucket = [F.col(doc), F.floor(F.col(line) / line_width)]
    return prefix_sum(lines, [doc, line], bucket, None, out, coarse=F.floor(F.col("__b0") / doc_group))
