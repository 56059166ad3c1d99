"""Token counts that follow edits: a segment tree of pre-tokens per document.

A document's state is its text, the end of each pre-token (pre-tokens are what the
tokenizer's pattern cuts; no merge crosses one) and a segment tree whose leaves are the token
counts of the pre-tokens, in blocks of ``LEAF`` pre-tokens, and whose root is the document's count.

An edit replaces ``text[start:end]``.  The pattern is matched again from the begin of the pre-token that
holds the character before the edit; it is memoryless at a pre-token's begin and looks ahead only, so as soon
as a new pre-token beyond the edit ends where an old one ended, the rest is as before.
Only the pre-tokens between are encoded; the sums above the touched blocks are
updated.  A document's edits apply one after the other, each to the text the one before left.

Nulls and edge cases: a null text counts as empty; null bounds or replacements count as 0 or the empty text; bounds outside
the text are moved to its ends and an end before the start counts as the start; edits of ids that no
document has are ignored; documents without edits keep their counts; rows that repeat an id get the same edits each; a null id
has no edits; an empty table gives an empty result.  Of other columns none are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 64
REMEMBERED = 500_000


class Counter:
    """Token counts of pre-tokens of a byte-level BPE vocabulary in tiktoken's file format."""

    def __init__(self, path: str, pattern: str):
        import base64

        import regex
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.lib.encode_ordinary(piece))
            if len(piece) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[piece] = n
        return n


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


class SegmentTree:
    """Sums over blocks of leaves; a leaf block is a list of counts.

    ``sums[1]`` is the root, node ``k`` has the children ``2k`` and ``2k + 1``.
    """

    def __init__(self, counts: list[int]):
        self.blocks = [counts[i:i + LEAF] for i in range(0, len(counts), LEAF)] or [[]]
        self._build()

    def _build(self) -> None:
        self.width = 1
        while self.width < len(self.blocks):
            self.width *= 2
        self.sums = [0] * self.width + [sum(b) for b in self.blocks] + [0] * (self.width - len(self.blocks))
        for k in range(self.width - 1, 0, -1):
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    @property
    def total(self) -> int:
        return self.sums[1]

    def replace(self, first: int, last: int, counts: list[int]) -> None:
        """Leaves ``first .. last - 1`` become ``counts``; only blocks they touch change their sums.

        Leaves are addressed by block, so a change of their number stays within the touched blocks: the
        first touched block takes what is new and the others shrink.
        """
        at = 0
        k = 0
        while k < len(self.blocks) - 1 and at + len(self.blocks[k]) <= first:
            at += len(self.blocks[k])
            k += 1
        lo = first - at
        rest = last - first
        touched = [k]
        take = min(rest, len(self.blocks[k]) - lo)
        self.blocks[k][lo:lo + take] = counts
        rest -= take
        j = k + 1
        while rest > 0:
            take = min(rest, len(self.blocks[j]))
            del self.blocks[j][:take]
            rest -= take
            touched.append(j)
            j += 1
        if len(self.blocks[k]) > 8 * LEAF:  # a large insertion: deal the leaves anew
            flat = [c for b in self.blocks for c in b]
            self.blocks = [flat[i:i + LEAF] for i in range(0, len(flat), LEAF)] or [[]]
            self._build()
            return
        for b in touched:
            n = self.width + b
            self.sums[n] = sum(self.blocks[b])
            while n > 1:
                n //= 2
                self.sums[n] = self.sums[2 * n] + self.sums[2 * n + 1]


class Document:
    """Text, pre-token ends and the segment tree of their token counts."""

    def __init__(self, text: str, counter: Counter):
        self.counter, self.text = counter, text
        pieces = counter.pattern.findall(text)
        at, self.ends = 0, []
        for p in pieces:
            at += len(p)
            self.ends.append(at)
        known = counter.known
        self.tree = SegmentTree([known[p] if p in known else counter.count(p) for p in pieces])

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace ``text[start:end]``; the number of pre-tokens that were encoded again."""
        size = len(self.text)
        start = min(max(start or 0, 0), size)
        end = min(max(end or 0, start), size)
        new = new or ""
        shift = len(new) - (end - start)
        old = self.ends
        self.text = self.text[:start] + new + self.text[end:]
        # the pre-token that holds the character before the edit, and the one before it, whose
        # lookahead ends there, begin the region
        first = max(0, bisect_right(old, start - 1) - 1) if start else 0
        at = old[first - 1] if first else 0
        border = start + len(new)  # from here on the text is as it was
        ends, counts, last = [], [], len(old)
        for m in self.counter.pattern.finditer(self.text, at):
            e = m.end()
            ends.append(e)
            counts.append(self.counter.count(m.group()))
            if e >= border:
                k = bisect_left(old, e - shift)
                if k < len(old) and old[k] == e - shift and e - shift >= end:
                    last = k + 1
                    break
        self.ends = old[:first] + ends + ([x + shift for x in old[last:]] if shift else old[last:])
        self.tree.replace(first, last, counts)
        return len(ends)


def count_edits(docs: DataFrame, edits: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_pretokens, n_edits, n_tokens_after, n_encoded``: counts before and after.

    ``edits`` has ``(id, seq, start, end, new)``; those of one document apply by ``seq``.
    ``n_encoded`` is the number of pre-tokens encoded again for them.
    """
    per_doc = edits.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("seq", "start", "end", "new"))).alias("edits"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(per_doc, "id", "left")
    return _apply(rows, vocab_path, pattern)


def _apply(rows: DataFrame, vocab_path: str, pattern: str) -> DataFrame:
    id_type = dict(rows.dtypes)["id"]

    def run(batches):
        counter = load(vocab_path, pattern)
        for b in batches:
            out = []
            for k in range(b.num_rows):
                doc = Document(b.column("text")[k].as_py() or "", counter)
                before, n = doc.tree.total, len(doc.ends)
                todo = b.column("edits")[k].as_py() or []
                again = sum(doc.edit(e["start"], e["end"], e["new"]) for e in todo)
                out.append((before, n, len(todo), doc.tree.total, again))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(c, pa.int64()) for c in cols]],
                                             ["id", "n_tokens", "n_pretokens", "n_edits", "n_tokens_after", "n_encoded"])

    return rows.select("id", "text", "edits").mapInArrow(
        run, f"id {id_type}, n_tokens long, n_pretokens long, n_edits long, n_tokens_after long, n_encoded long")


def derived_edits(text, ident):
    """Three edits that depend on the document alone: a deletion, an insertion of the
    text's own first characters, and a replacement (columns of ``edits``)."""
    size = F.length(text)
    at = lambda k: F.pmod(F.xxhash64(ident, F.lit(k)), F.greatest(size, F.lit(1)).cast("long")).cast("int")
    one = lambda seq, a, b, new: F.struct(F.lit(seq).alias("seq"), a.alias("start"), b.alias("end"), new.alias("new"))
    return F.array(one(1, at(1), at(1) + 11, F.lit("")), one(2, at(2), at(2), F.concat(F.lit(" "), F.left(text, F.lit(25)))),
                   one(3, at(3), at(3) + 5, F.lit("it's 2024\n")))


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    # the edits are a function of the row here, so they need no join
    rows = docs.select(F.col("doc_id").alias("id"), text.alias("text")).withColumn("edits", derived_edits(F.col("text"), F.col("id")))
    out = _apply(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")
