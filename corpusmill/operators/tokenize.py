"""Token encode/decode and tokenizer evaluation.

The word tokenizer encodes by joining words with the vocabulary.
Lines are dealt to groups by a hash of their key; only the distinct words of a
group are joined with the vocabulary (broadcast when small enough: its size is
counted after a checkpoint, not guessed), and each group's lines then meet the
part of the vocabulary that they use.  A word held by a third of the corpus is
one row a group in that join, and the lines are shuffled once, as text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import text as T
from .vocab import BOS_ID, EOS_ID, PAD_ID, UNK_ID

MAX_BROADCAST_VOCAB_BYTES = 64 << 20


@dataclass(frozen=True)
class SpecialIds:
    """Special token ids; resolves unset (-1) ids and rejects collisions (T5)."""
    pad: int = PAD_ID
    bos: int = BOS_ID
    eos: int = EOS_ID
    unk: int = UNK_ID
    allow_pad_eq_eos: bool = False

    def resolved(self, vocab_size: int | None = None) -> "SpecialIds":
        defaults = {"pad": PAD_ID, "bos": BOS_ID, "eos": EOS_ID, "unk": UNK_ID}
        vals = {k: (defaults[k] if getattr(self, k) < 0 else getattr(self, k)) for k in defaults}
        if vocab_size is not None:
            vals = {k: min(v, vocab_size - 1) for k, v in vals.items()}
        out = SpecialIds(**vals, allow_pad_eq_eos=self.allow_pad_eq_eos)
        out.validate()
        return out

    def validate(self) -> None:
        ids = [self.pad, self.bos, self.eos, self.unk]
        if self.allow_pad_eq_eos:
            ids = [self.bos, self.eos, self.unk] + ([] if self.pad == self.eos else [self.pad])
        if len(set(ids)) != len(ids):
            raise ValueError(f"special ids collide: {self}")


SPECIALS = SpecialIds()


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def vocab_fits_broadcast(vocab: DataFrame, max_bytes: int = MAX_BROADCAST_VOCAB_BYTES) -> bool:
    """Checked size bound: true when the pieces of the (materialised) vocabulary, with 24 bytes
    for the rest of each row, take at most ``max_bytes`` (a "word" may be very long)."""
    size = vocab.agg(F.coalesce(F.sum(F.octet_length("piece") + 24), F.lit(0))).first()[0]
    return size <= max_bytes


# text (or 4-byte ids) of the rows that share one part of the vocabulary: both are in one task's memory
GROUP_BYTES = 8 << 20
# small inputs have smaller groups, as long as cores are idle
MIN_GROUP_BYTES = 1 << 20


def _group_count(src: DataFrame, col: str) -> int:
    size = F.octet_length(col) if dict(src.dtypes)[col] == "string" else F.greatest(F.size(col), F.lit(0)) * 4
    total = src.agg(F.coalesce(F.sum(size + 8), F.lit(0))).first()[0]
    cores = src.sparkSession.sparkContext.defaultParallelism
    return max(total // GROUP_BYTES, min(cores, total // MIN_GROUP_BYTES)) + 1


def _interleave(parts: list[list[list]]) -> list[list]:
    """The values at each place of several rows with one key, as if they were one row."""
    places = range(max(map(len, parts)))
    return [sorted((v for p in parts if k < len(p) for v in p[k]), key=lambda v: (v is not None, v)) for k in places]


def _look_up(src: DataFrame, col: str, entries: Column, read, table: DataFrame, missing, write, out: str,
             out_type: str, keys: list[str], broadcast: bool, groups: int | None) -> DataFrame:
    """``(*keys, out)``: the rows of ``src`` with the entries of ``col`` replaced by their values in ``table``.

    Rows are dealt to groups by a hash of their keys.  Only the distinct entries of a group are joined with
    ``table (__entry, __value)``, so no occurrence is a row of a shuffle or a sort; then each group meets its part
    of the table.  ``entries`` and ``read`` give a row's entries in Spark and in a task, ``write`` makes the column of
    the values.  Rows with one key make one row, place by place.
    """
    groups = groups or _group_count(src, col)
    names = [f"__k{i}" for i in range(len(keys))]
    rows = src.select(F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("__group"),
                      *[F.col(c).alias(n) for c, n in zip(keys, names)], F.col(col).alias("__row"))
    # dealt before they are taken apart: the entries of a group are found where the group is
    dealt = rows.select(F.col("__group").alias("__of"), "__row").repartition("__of")
    wanted = dealt.select("__of", F.explode(entries).alias("__entry")).distinct()
    part = wanted.join(F.broadcast(table) if broadcast else table, "__entry").select("__of", "__entry", "__value")
    types = dict(src.dtypes)
    schema = ", ".join([*(f"{n} {types[c]}" for c, n in zip(keys, names)), f"`{out}` {out_type}"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        entries, found = right.column("__entry").to_pylist(), right.column("__value").to_pylist()
        one = dict(zip(entries, found))
        data = left.column("__row").to_pylist()
        same: dict = {}
        for i, k in enumerate(zip(*(left.column(n).to_pylist() for n in names))):
            same.setdefault(k, []).append(i)
        if len(same) == len(data) and len(one) == len(entries):
            values = [[one.get(e, missing) for e in read(row)] for row in data]
        else:
            values, known = [], {}
            for k, v in zip(entries, found):
                known.setdefault(k, []).append(v)
            for at in same.values():
                places = _interleave([[known.get(e, [missing]) for e in read(data[i])] for i in at])
                values.append([v for place in places for v in place])
            left = left.take([at[0] for at in same.values()])
        return pa.table([*(left.column(n) for n in names), write(values)], names=[*names, out])

    done = rows.groupBy("__group").cogroup(part.groupBy("__of")).applyInArrow(run, schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(keys, names)], out)


def _id_lists(rows: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter((i for r in rows for i in r), np.int32, ends[-1])))


def _joined_pieces(rows: list[list]) -> pa.Array:
    return pa.array([" ".join([p for p in r if p is not None]) for r in rows], pa.string())


# symbols (characters and ids, 16 for the entry) of the words that a task remembers, in each of two generations
REMEMBERED = 8_000_000
# ids of a batch that a task hands back
BATCH_IDS = 1 << 20


class Remembered(dict):
    """Values of words, found by ``of``; what was not asked for since the last generation is dropped."""

    def __init__(self, of, most: int = REMEMBERED):
        self.of, self.most, self.size, self.old = of, most, 0, {}

    def __missing__(self, word: str) -> list[int]:
        ids = self.old.get(word)
        if ids is None:
            ids = self.of(word)
        self.size += len(word) + len(ids) + 16
        if self.size > self.most:
            self.old, self.size = dict(self), len(word) + len(ids) + 16
            self.clear()
        self[word] = ids
        return ids


def rows_by_key(src: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """``(*keys, __rows)``: the values of ``col`` of all rows with one key."""
    if src.groupBy(*keys).count().filter("count > 1").limit(1).count():
        return src.groupBy(*keys).agg(F.collect_list(col).alias("__rows"))
    return src.select(*keys, F.array(col).alias("__rows"))


def map_rows(src: DataFrame, keys: list[str], out: str, out_type: ST.DataType, make, write, size=len) -> DataFrame:
    """``(*keys, out)``: ``make()`` gives a task's function of ``__rows``; ``write`` makes a column of its values."""
    schema = ST.StructType([*(src.schema[k] for k in keys), ST.StructField(out, out_type)])

    def run(batches):
        of = make()
        for b in batches:
            values, total, first = [], 0, 0
            for k, rows in enumerate(b.column("__rows").to_pylist(), 1):
                values.append(of(rows))
                total += size(values[-1])
                if total >= BATCH_IDS or k == b.num_rows:
                    part = b.slice(first, k - first)
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keys), write(values)], names=[*keys, out])
                    values, total, first = [], 0, k
    return src.select(*keys, "__rows").mapInArrow(run, schema)


def encode_by_word(lines: DataFrame, key_cols, text_col: str, out: str, make) -> DataFrame:
    """``(*key_cols, out)``: ids of the words of each line, one after the other; blank lines give ``[]``.

    ``make()`` gives a task's function from a word to its ids, which it remembers, so no word is a row of a shuffle.
    Rows with one key make one row, place by place.
    """
    keys = list(key_cols)

    def line_ids():
        known = Remembered(make())

        def of(rows):
            if len(rows) == 1:
                return [i for w in (rows[0] or "").split() for i in known[w]]
            places = _interleave([[[known[w]] for w in (t or "").split()] for t in rows]) if rows else []
            return [i for place in places for ids in place for i in ids]
        return of
    return map_rows(rows_by_key(lines, text_col, keys), keys, out, ST.ArrayType(ST.IntegerType()), line_ids, _id_lists)


def encode_words(lines: DataFrame, vocab: DataFrame, key_cols, text_col: str = "line",
                 out: str = "ids", broadcast_vocab: bool | None = None, groups: int | None = None) -> DataFrame:
    """``(*key_cols, ids)``: ids of the whitespace words of each line, UNK for unknown words.

    Blank lines get an empty array.  ``vocab`` has ``(piece, id)``.
    """
    v = vocab.select(F.col("piece").alias("__entry"), F.coalesce("id", F.lit(UNK_ID)).cast("int").alias("__value"))
    if broadcast_vocab is None:
        broadcast_vocab = vocab_fits_broadcast(vocab)
    # str.split() splits as T.split_words does
    return _look_up(lines, text_col, T.split_words("__row"), lambda t: (t or "").split(), v, UNK_ID, _id_lists, out,
                    "array<int>", list(key_cols), broadcast_vocab, groups)


def decode_words(tokens: DataFrame, vocab: DataFrame, key_cols, ids_col: str = "ids",
                 out: str = "text", specials: SpecialIds = SPECIALS,
                 broadcast_vocab: bool | None = None, groups: int | None = None) -> DataFrame:
    """Inverse of ``encode_words``: PAD/BOS/EOS dropped, pieces joined by one space."""
    v = vocab.select(F.col("id").alias("__entry"), F.col("piece").alias("__value"))
    if broadcast_vocab is None:
        broadcast_vocab = vocab_fits_broadcast(vocab)
    drop = [specials.pad, specials.bos, specials.eos]
    kept = tokens.withColumn(ids_col, F.filter(ids_col, lambda i: ~i.isin(drop)))
    return _look_up(kept, ids_col, F.col("__row"), lambda ids: ids or [], v, None, _joined_pieces, out,
                    "string", list(key_cols), broadcast_vocab, groups)


def offset_clamp(ids, vocab_size: int | None, offset: int = 3) -> Column:
    """``min(id + offset, V - 1)``; unclamped when ``vocab_size`` is None."""
    if vocab_size is None:
        return F.transform(_c(ids), lambda i: i + F.lit(offset))
    return F.transform(_c(ids), lambda i: F.least(i + F.lit(offset), F.lit(vocab_size - 1)))


def wrap_special(ids, bos: int | None = BOS_ID, eos: int | None = EOS_ID) -> Column:
    """``[BOS] + ids + [EOS]``; pass None to leave either side off (T4)."""
    parts = []
    if bos is not None:
        parts.append(F.array(F.lit(bos)))
    parts.append(_c(ids))
    if eos is not None:
        parts.append(F.array(F.lit(eos)))
    return F.concat(*parts).cast("array<int>")


def byte_pieces(ch) -> Column:
    """UTF-8 byte pieces ``<0xNN>...`` of a string."""
    return F.regexp_replace(F.hex(F.encode(_c(ch), "UTF-8")), "(..)", "<0x$1>")


def byte_fallback(chars: DataFrame, ch_col: str = "ch", kept_col: str = "kept",
                  out: str = "pieces") -> DataFrame:
    """Characters inside the alphabet stay one piece, the others become byte pieces."""
    return chars.withColumn(out, F.when(F.col(kept_col), F.col(ch_col)).otherwise(byte_pieces(ch_col)))


# The published reference numbers the comparison rule is stated against.
BASELINE_TOKENS_PER_WORD = 1.3085
BASELINE_MAX_TOKENS = 24
BASELINE_RECONSTRUCTION = 0.9606


def tokenizer_eval(lines: DataFrame, n_tokens_col: str, n_words_col: str, error_col: str,
                   blank_col: str, index_col: str | None = None, n_lines: int | None = None,
                   digits: int = 6) -> DataFrame:
    """Aggregate per-line results into the tokenizer report.

    Input: one row per line with its token count, word count, reconstruction
    error flag and blank flag.  With ``n_lines`` only lines whose 0-based global
    index (``index_col``) is below it are read; blank lines use up an index.
    ``reconstruction_rate_ref`` keeps the reference's denominator (the last
    index read); ``reconstruction_rate`` divides by the non-blank lines read.
    """
    read = F.lit(True) if n_lines is None else F.col(index_col) < n_lines
    ok = read & ~F.col(blank_col)
    agg = lines.agg(
        F.count("*").cast("long").alias("__n_all"),
        F.sum(F.when(read, 1).otherwise(0)).cast("long").alias("n_lines"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("n_nonblank"),
        F.sum(F.when(ok, F.col(n_tokens_col)).otherwise(0)).cast("long").alias("n_tokens"),
        F.sum(F.when(ok, F.col(n_words_col)).otherwise(0)).cast("long").alias("n_words"),
        F.max(F.when(ok, F.col(n_tokens_col)).otherwise(0)).cast("long").alias("max_tokens_in_line"),
        F.sum(F.when(ok & F.col(error_col), 1).otherwise(0)).cast("long").alias("n_errors"),
    )
    # the reference loop's last index: n - 1 when the input ends first, n_lines when cut off
    last_index = F.col("__n_all") - 1
    if n_lines is not None:
        last_index = F.when(F.col("__n_all") > n_lines, F.lit(n_lines)).otherwise(last_index)
    return agg.select(
        "n_lines", "n_tokens", "n_words", "max_tokens_in_line", "n_errors",
        F.round(F.col("n_tokens") / (F.col("n_words") + F.lit(1e-9)), digits).alias("avg_tokens_per_word"),
        F.round(F.lit(1.0) - F.col("n_errors") / (last_index + F.lit(1e-9)), digits)
        .alias("reconstruction_rate_ref"),
        F.round(F.when(F.col("n_nonblank") > 0, F.lit(1.0) - F.col("n_errors") / F.col("n_nonblank")),
                digits).alias("reconstruction_rate"),
    )


def tokenizer_compare(report: DataFrame, base_tokens_per_word: float = BASELINE_TOKENS_PER_WORD,
                      base_max_tokens: int = BASELINE_MAX_TOKENS,
                      base_reconstruction: float = BASELINE_RECONSTRUCTION) -> DataFrame:
    """Verdict of a T7 report against a baseline (T8): better iff tokens/word falls
    and reconstruction does not drop; a longer longest line alone is tolerated."""
    fewer = F.col("avg_tokens_per_word") < F.lit(base_tokens_per_word)
    keeps = F.col("reconstruction_rate") >= F.lit(base_reconstruction)
    return report.select(
        "*",
        F.lit(base_tokens_per_word).alias("base_avg_tokens_per_word"),
        F.lit(base_max_tokens).cast("long").alias("base_max_tokens_in_line"),
        F.lit(base_reconstruction).alias("base_reconstruction_rate"),
        F.when(fewer & keeps, "better")
        .when(~keeps, "worse")
        .when(F.col("avg_tokens_per_word") == F.lit(base_tokens_per_word), "equal")
        .otherwise("worse").alias("verdict"),
        (F.col("max_tokens_in_line") > F.lit(base_max_tokens)).alias("longer_max_line"),
    )
