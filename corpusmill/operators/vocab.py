"""Vocabulary statistics and construction as Spark counting jobs.

All of these are aggregations with map-side combine: a word or pair held by a
third of the corpus collapses per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.sinks import materialize
from .ordering import global_rank

# Special ids of the word vocabulary (PAD 0, BOS 1, EOS 2, UNK 3,
# ordinary pieces from 4 = 3 + rank), the unknown piece and the word-start marker.
PAD_ID, BOS_ID, EOS_ID, UNK_ID = 0, 1, 2, 3
SPECIAL_PIECES = [("<pad>", PAD_ID), ("<s>", BOS_ID), ("</s>", EOS_ID), ("<unk>", UNK_ID)]
WORD_START = "▁"


def word_table(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """``(word, count)`` of whitespace words (V3)."""
    words = lines.select(F.explode(T.split_words(text_col)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("count"))


def _rank_bucket():
    # Monotone in (count desc, word asc): the count, then -- only where many
    # words share a small count -- a 3-character word prefix.
    return [-F.col("count"),
            F.when(F.col("count") <= 16, F.substring("word", 1, 3)).otherwise(F.lit(""))]


def build_vocab(words: DataFrame, word_col: str = "word", count_col: str = "count") -> DataFrame:
    """``(piece, id, count)``: specials first, then id = 3 + rank by (count desc, piece asc) (V7)."""
    w = words.select(F.col(word_col).alias("word"), F.col(count_col).cast("long").alias("count"))
    ranked = global_rank(w, [F.col("count").desc(), F.col("word").asc()], _rank_bucket(), "rank")
    pieces = ranked.select(F.col("word").alias("piece"),
                           (F.col("rank") + UNK_ID).cast("int").alias("id"), "count")
    spark = words.sparkSession
    specials = spark.createDataFrame(
        [(p, i, None) for p, i in SPECIAL_PIECES], "piece string, id int, count long")
    return specials.unionByName(pieces)


def sentence_sample(lines: DataFrame, key_cols, n: int = 1_000_000, seed: int = 42) -> DataFrame:
    """The ``n`` lines with the smallest seeded hash key ``md5('k1:k2:...:seed')`` (V1):
    a deterministic pseudo-random sample of at most ``n`` lines.

    A plain ``orderBy(key).limit(n)`` ends in one task that merges every
    task's local top-n.  Instead the key's leading 52 bits are read as a
    uniform ``u``; rows with ``u`` below a fraction chosen from the counted
    total (about ``1.05 n`` expected rows) are the candidates -- doubled until
    there are at least ``n`` -- and only the candidates are ranked with the
    distributed global rank.  Since ``u`` is monotone in the key, the result is
    exactly the ``n`` smallest keys.  The keyed lines and the candidates feed several
    passes (counts, ranks) and are written once each.
    """
    key = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))
    d = materialize(lines.withColumn("sample_key", key), "sample-lines")
    total = d.count()
    if total <= n:
        return d
    u = F.conv(F.substring("sample_key", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    frac = min(1.0, (1.05 * n + 1000) / total)
    while True:
        cand = materialize(d.filter(u < F.lit(frac)), "sample-candidates")
        if frac >= 1.0 or cand.count() >= n:
            break
        frac = min(1.0, frac * 2)
    ranked = global_rank(cand, [F.col("sample_key")] + [F.col(c) for c in key_cols],
                         F.conv(F.substring("sample_key", 1, 5), 16, 10).cast("long"), "__r")
    return ranked.filter(F.col("__r") <= n).drop("__r")


def char_table(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """``(ch, n)``: code-point frequencies (``.`` in Java regex is one code point)."""
    chars = lines.select(F.explode(F.regexp_extract_all(text_col, F.lit("(?s)."), 0)).alias("ch"))
    return chars.groupBy("ch").agg(F.count("*").alias("n"))


def char_coverage(lines: DataFrame, text_col: str = "line", coverage: float = 0.9995) -> DataFrame:
    """Most frequent characters kept until their share reaches ``coverage`` (V2).

    ``(ch, n, cum_before, total, kept)``; the character table is bounded by the
    size of Unicode, so one ordered window over it is cheap.
    """
    chars = char_table(lines, text_col)
    frame = Window.orderBy(F.col("n").desc(), F.col("ch")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = chars.select("ch", "n", F.coalesce(F.sum("n").over(frame), F.lit(0)).cast("long")
                          .alias("cum_before"), F.sum("n").over(Window.partitionBy()).cast("long")
                          .alias("total"))
    # exact integer comparison: cum_before / total < coverage
    num, den = _ratio(coverage)
    return ranked.withColumn("kept", F.col("cum_before") * den < F.col("total") * num)


def _ratio(x: float) -> tuple[int, int]:
    den = 10_000_000
    return round(x * den), den


def bpe_pair_counts(words: DataFrame, word_col: str = "word", count_col: str = "count") -> DataFrame:
    """``(left, right, n)``: adjacent-character pair counts weighted by word frequency (V4).

    Each word is prefixed with the word-start marker, as subword trainers do.
    """
    sym = F.regexp_extract_all(F.concat(F.lit(WORD_START), F.col(word_col)), F.lit("(?s)."), 0)
    w = words.select(sym.alias("s"), F.col(count_col).alias("c"))
    pairs = w.select(F.explode(F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("l"),
                                            F.slice("s", 2, F.size("s")).alias("r"))).alias("p"),
                     "c")
    return (pairs.groupBy(F.col("p.l").alias("left"), F.col("p.r").alias("right"))
            .agg(F.sum("c").cast("long").alias("n")))
