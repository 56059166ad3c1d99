"""Unigram-LM subword vocabulary training.

1. Seed pieces: every substring (up to ``max_piece_len`` characters) of every
   distinct word, weighted by word frequency -- an explode plus an aggregate;
   all single characters plus the best ``seed_size`` longer pieces by
   (frequency * length) are kept.
2. EM: the E-step runs forward-backward over each *distinct* word's piece
   lattice in ``mapInPandas`` (a small per-word helper; the piece table,
   bounded by ``seed_size``, is broadcast) and emits expected piece counts
   times the word frequency, summed up in the task; the M-step is ``groupBy(piece).sum`` and a
   normalisation.
3. Pruning keeps the ``vocab_size`` pieces with the largest expected counts
   (single characters are always kept so every word stays segmentable), and
   EM runs again on the pruned set.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import materialize
from .tokenize import encode_by_word
from .vocab import UNK_ID, WORD_START


def _marked(word_col: str):
    return F.concat(F.lit(WORD_START), F.col(word_col))


def seed_pieces(words: DataFrame, seed_size: int, max_piece_len: int = 8, word_col: str = "word",
                count_col: str = "count") -> DataFrame:
    """``(piece, freq)`` seed set: all characters and the top longer substrings."""
    w = words.select(_marked(word_col).alias("w"), F.col(count_col).alias("c"))
    n = F.length("w")
    # single characters, bounded by the alphabet, apart from the many longer pieces
    single = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring("w", i, F.lit(1)))
    subs = F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.transform(
        F.sequence(i + 1, F.least(i + max_piece_len - 1, n)), lambda j: F.substring("w", i, j - i + 1))))
    chars, longer = (rows.select(F.explode(pieces).alias("piece"), "c").groupBy("piece").agg(F.sum("c").alias("freq"))
                     for rows, pieces in ((w, single), (w.filter((n > 1) & F.lit(max_piece_len > 1)), subs)))
    longer = longer.orderBy((F.col("freq") * F.length("piece")).desc(), "piece").limit(seed_size)
    return chars.unionByName(longer)


def _starts(logp: dict) -> dict:
    """Log-probabilities of the pieces, None for what is only the start of some: what is missing begins no piece."""
    out = dict.fromkeys(p[:k] for p in logp for k in range(1, len(p)))
    out.update(logp)
    return out


def _forward_backward(word: str, logp: dict, max_len: int, starts: dict | None = None):
    """Expected piece counts of one word under the unigram model (log space)."""
    n = len(word)
    neg = -math.inf
    get, log1p, exp = (starts or _starts(logp)).get, math.log1p, math.exp
    # the pieces of the word, looked up once: by their starts and by their ends
    begin: list = [[] for _ in range(n + 1)]
    finish: list = [[] for _ in range(n + 1)]
    for start in range(n):
        for end in range(start + 1, min(n, start + max_len) + 1):
            p = word[start:end]
            lp = get(p, False)
            if lp is False:
                break
            if lp is not None:
                begin[start].append((end, lp, p))
                finish[end].append((start, lp))
    alpha = [neg] * (n + 1)
    alpha[0] = 0.0
    for end in range(1, n + 1):
        acc = neg
        for start, lp in finish[end]:
            if alpha[start] > neg:
                v = alpha[start] + lp
                if acc == neg:
                    acc = v
                elif acc >= v:
                    acc += log1p(exp(v - acc))
                else:
                    acc = v + log1p(exp(acc - v))
        alpha[end] = acc
    if alpha[n] == neg:
        return {}, neg
    beta = [neg] * (n + 1)
    beta[n] = 0.0
    for start in range(n - 1, -1, -1):
        acc = neg
        for end, lp, _ in begin[start]:
            if beta[end] > neg:
                v = beta[end] + lp
                if acc == neg:
                    acc = v
                elif acc >= v:
                    acc += log1p(exp(v - acc))
                else:
                    acc = v + log1p(exp(acc - v))
        beta[start] = acc
    z = alpha[n]
    out: dict = {}
    for start in range(n):
        if alpha[start] == neg:
            continue
        for end, lp, p in begin[start]:
            if beta[end] == neg:
                continue
            post = exp(alpha[start] + lp + beta[end] - z)
            if post > 0:
                out[p] = out.get(p, 0.0) + post
    return out, z


def _e_step(words: DataFrame, pieces: DataFrame, max_len: int) -> DataFrame:
    spark = words.sparkSession
    table = {r["piece"]: r["logp"] for r in pieces.select("piece", "logp").collect()}
    bc = spark.sparkContext.broadcast(table)

    def run(batches):
        logp = bc.value
        starts = _starts(logp)
        sums: dict = {}  # bounded by the piece table
        for pdf in batches:
            for w, c in zip(pdf["w"], pdf["c"]):
                for p, e in _forward_backward(w, logp, max_len, starts)[0].items():
                    sums[p] = sums.get(p, 0.0) + e * c
        yield pd.DataFrame({"piece": list(sums), "expected": list(sums.values())})
    return words.mapInPandas(run, "piece string, expected double")


def _m_step(expected: DataFrame) -> DataFrame:
    agg = expected.groupBy("piece").agg(F.sum("expected").alias("expected"))
    # the piece table is bounded by the seed size, so one total over it is cheap
    tot = F.sum("expected").over(Window.partitionBy())
    return agg.select("piece", "expected", F.log(F.col("expected") / tot).alias("logp"))


def train_unigram(words: DataFrame, vocab_size: int, seed_size: int | None = None, em_iters: int = 2,
                  max_piece_len: int = 8, word_col: str = "word", count_col: str = "count") -> DataFrame:
    """``(piece, logp, expected)``: the trained piece table, at most ``vocab_size`` pieces
    plus any single characters needed to cover the alphabet."""
    seed_size = seed_size or 4 * vocab_size
    w = materialize(words.select(_marked(word_col).alias("w"), F.col(count_col).cast("double").alias("c")),
                    "unigram-words")
    seeds = seed_pieces(words, seed_size, max_piece_len, word_col, count_col)
    pieces = materialize(_m_step(seeds.select("piece", F.col("freq").cast("double").alias("expected"))),
                         "unigram-pieces")
    for _ in range(em_iters):
        pieces = materialize(_m_step(_e_step(w, pieces, max_piece_len)), "unigram-pieces")
    ranked = pieces.withColumn("__single", F.length("piece") == 1)
    keep = ranked.filter(~F.col("__single")).orderBy(F.col("expected").desc(), "piece").limit(
        max(vocab_size - ranked.filter("__single").count(), 0))
    pruned = ranked.filter("__single").unionByName(keep).drop("__single")
    pieces = materialize(_m_step(_e_step(w, materialize(pruned, "unigram-pieces"), max_piece_len)),
                         "unigram-pieces")
    return pieces


def viterbi(word: str, logp: dict, max_len: int = 8, starts: dict | None = None) -> list[str]:
    """Best segmentation of one (marked) word; used by tests and encoders."""
    n = len(word)
    get = (starts or _starts(logp)).get
    best = [-math.inf] * (n + 1)
    back = [0] * (n + 1)
    best[0] = 0.0
    for start in range(n):
        so_far = best[start]
        if so_far == -math.inf:
            continue
        for end in range(start + 1, min(n, start + max_len) + 1):
            lp = get(word[start:end], False)
            if lp is False:
                break
            if lp is not None and so_far + lp > best[end]:
                best[end], back[end] = so_far + lp, start
    out, end = [], n
    while end > 0:
        out.append(word[back[end]:end])
        end = back[end]
    return out[::-1]


def unigram_vocab(pieces: DataFrame) -> DataFrame:
    """``(piece, id)``: specials, then pieces by (log-probability desc, piece)."""
    spark = pieces.sparkSession
    # the piece table is bounded by the requested vocabulary size
    ranked = pieces.select("piece", F.row_number().over(
        Window.orderBy(F.col("logp").desc(), "piece")).alias("r"))
    specials = spark.createDataFrame([("<pad>", 0), ("<s>", 1), ("</s>", 2), ("<unk>", 3)], "piece string, id int")
    return specials.unionByName(ranked.select("piece", (F.col("r") + F.lit(3)).cast("int").alias("id")))


def encode_unigram(lines: DataFrame, pieces: DataFrame, vocab: DataFrame, key_cols, text_col: str = "line",
                   out: str = "ids", max_piece_len: int = 8) -> DataFrame:
    """``(*key_cols, ids)``: Viterbi segmentation of the words of a task, which remembers them, with the
    broadcast piece table, one after the other for each line.  Characters outside the piece table become UNK."""
    sc = lines.sparkSession.sparkContext
    table = {r["piece"]: r["logp"] for r in pieces.select("piece", "logp").collect()}
    # bounded by the vocabulary, as the pieces are; a piece that is spelled as a special has both ids
    ids: dict = {}
    for r in vocab.select("piece", F.coalesce("id", F.lit(UNK_ID)).alias("id")).collect():
        ids.setdefault(r["piece"], []).append(r["id"])
    bc = sc.broadcast((table, {p: sorted(i) for p, i in ids.items()}))

    def word_ids():
        logp, of = bc.value
        starts = _starts(logp)
        unknown: list = []

        def run(word):
            marked = WORD_START + word
            seg = viterbi(marked, logp, max_piece_len, starts)
            if "".join(seg) != marked:
                if not unknown:
                    unknown.extend(_unknown_table(logp))
                seg = _with_unknown(marked, *unknown, max_piece_len)
            return [i for p in seg for i in of.get(p, (UNK_ID,))]
        return run
    return encode_by_word(lines, key_cols, text_col, out, word_ids)


def _unknown_table(logp: dict) -> tuple[dict, float]:
    """A copy of the pieces and what an unknown character costs."""
    return dict(logp), min(logp.values()) - 20.0 if logp else -20.0


def _with_unknown(word: str, table: dict, floor: float, max_len: int) -> list[str]:
    """Segmentation where characters without a piece are kept as single
    (unknown) symbols, so every word still has a segmentation; ``table`` takes them up."""
    for ch in word:
        table.setdefault(ch, floor)
    return viterbi(word, table, max_len)
