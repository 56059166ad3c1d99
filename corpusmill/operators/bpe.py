"""BPE vocabulary training and subword encoding.

Training gives exactly the merges of sequential BPE (the most frequent adjacent pair first, ties by
left and right symbol), many to a round.  The words, as arrays of symbol ids with their frequencies, stay
distributed, in blocks, and are written once a round:

1. Pairs are counted in Arrow batches and summed by Spark.  The pairs that occur at least ``floor``
   times are *live*; ``floor`` is the least value for which they and step 2 keep within bounds.
2. Words are cut where a pair is not live.  What is left, *chains* of live pairs, is summed up
   over all words and goes to the driver: at most ``MAX_SYMBOLS`` symbols, whatever the corpus.
3. The driver merges on the chains alone (:class:`_Chains`).  A pair that a merge creates stems from
   a pair of the start of the round: it is in the chains if that one was live, and rarer than ``floor`` if
   not.  So while the best pair counts ``floor`` or more, its choice and count are those of the
   whole corpus.  A merge may give a string that another merge has given; then the pairs of that symbol
   have several origins, some of them not in the chains; the round ends where they could matter.
4. The driver's chains, before and after the merges, are the table by which all words are rewritten.

A round has at least one merge, usually hundreds; the next round starts from new counts.

Encoding applies the merges in order to the words of a task, which remembers them (short words pair by pair, long ones
by a linked list and a heap, linear but for a logarithm in the word's length); no word is a row of a shuffle.

With a coverage below 1 characters outside the covered alphabet are no symbols: training cuts
words there, and encoding writes them as UTF-8 byte pieces, if the vocabulary has them, or UNK.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..sources.sinks import materialize
from .tokenize import _interleave, encode_by_word, map_rows, rows_by_key
from .vocab import UNK_ID, WORD_START

#: bounds of what a round brings to the driver: symbols in chains, live pairs
MAX_SYMBOLS, MAX_PAIRS = 250_000, 100_000
#: live pairs to try in the first round; a round tries four times as many as the last one could have
FIRST_PAIRS = 128


def _symbols(word: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(WORD_START), word), F.lit("(?s)."), 0)


def alphabet(words: DataFrame, word_col: str = "word", count_col: str = "count", coverage: float = 1.0) -> list[str]:
    """Base symbols by (frequency desc, symbol): the most frequent ones whose share reaches ``coverage``,
    and the word start.  Bounded by the size of Unicode."""
    chars = (words.select(F.explode(_symbols(F.col(word_col))).alias("ch"), F.col(count_col).alias("c"))
             .groupBy("ch").agg(F.sum("c").alias("n")).collect())
    chars.sort(key=lambda r: (-r["n"], r["ch"]))
    total, seen, kept = sum(r["n"] for r in chars), 0, []
    for r in chars:
        # whole numbers: the share before this character is below the coverage
        if seen * 10_000_000 < total * round(coverage * 10_000_000) or r["ch"] == WORD_START:
            kept.append(r["ch"])
        seen += r["n"]
    return kept


# ------------------------------------------------------------------ one round on the driver

class _Chains:
    """Merges on chains of live pairs, as linked lists over flat arrays."""

    def __init__(self, flat: np.ndarray, lens: np.ndarray, weights: np.ndarray, names: list[str], floor: int):
        self.names, self.ids, self.floor = names, {s: i for i, s in enumerate(names)}, floor
        n, ends = len(flat), np.cumsum(lens)
        self.sym = flat.astype(np.int64)
        self.nxt = np.arange(1, n + 1)
        self.nxt[ends - 1] = -1
        self.prv = np.arange(-1, n - 1)
        self.prv[ends - lens] = -1
        self.weight = np.repeat(weights, lens)
        left = np.flatnonzero(self.nxt >= 0)
        self.count: dict[int, int] = {}
        self.at: dict[int, list] = {}
        self.pairs_of: dict[int, set] = {}
        self.heap: list = []
        self._add(left)
        heapq.heapify(self.heap)
        self.live = set(self.count)
        # symbols of the round's start that a symbol's occurrences may begin and end with
        self.first: dict[int, frozenset] = {}
        self.last: dict[int, frozenset] = {}
        self.loose: list = []  # pairs with an origin outside the chains, by their greatest possible count
        self.origins = 1       # greatest number of origins of any pair

    def _keys(self, left):
        return self.sym[left] << 32 | self.sym[self.nxt[left]]

    def _sums(self, left):
        keys, inverse = np.unique(self._keys(left), return_inverse=True)
        sums = np.zeros(len(keys), dtype=np.int64)
        np.add.at(sums, inverse, self.weight[left])
        return keys.tolist(), sums.tolist(), inverse

    def _add(self, left, offer=list.append):
        """Count the pairs that start at ``left``."""
        keys, sums, inverse = self._sums(left)
        places = np.split(left[np.argsort(inverse, kind="stable")], np.cumsum(np.bincount(inverse, minlength=len(keys)))[:-1]) if keys else []
        for key, s, p in zip(keys, sums, places):
            if key not in self.count:
                for x in (key >> 32, key & 0xFFFFFFFF):
                    self.pairs_of.setdefault(x, set()).add(key)
            self.count[key] = c = self.count.get(key, 0) + s
            self.at.setdefault(key, []).append(p)
            offer(self.heap, (-c, self.names[key >> 32], self.names[key & 0xFFFFFFFF], key))

    def _outside(self, key: int) -> int:
        """How many origins of a pair are not in the chains."""
        l, r = key >> 32, key & 0xFFFFFFFF
        return sum((x << 32 | y) not in self.live for x in self.last.get(l, (l,)) for y in self.first.get(r, (r,)))

    def _upper(self, key: int) -> int:
        return self.count.get(key, 0) + self._outside(key) * (self.floor - 1)

    def _certain(self, key: int, c: int) -> bool:
        """Whether a pair of count ``c`` that leads in the chains leads in the corpus, with that count."""
        if self._outside(key) * (self.floor - 1):
            return False
        while self.loose:
            bound, other = -self.loose[0][0], self.loose[0][1]
            now = self._upper(other)
            if now == self.count.get(other, 0):
                heapq.heappop(self.loose)
            elif now < bound:
                heapq.heapreplace(self.loose, (-now, other))
            elif bound >= c:
                return False
            else:
                break
        return self.origins == 1 or self.origins * (self.floor - 1) < c

    def merges(self, limit: int) -> list[tuple[int, int, int, int]]:
        """``(left, right, merged, count)``, as many as are certain and at most ``limit``; extends ``names``."""
        out = []
        while self.heap and len(out) < limit:
            c, key = -self.heap[0][0], self.heap[0][3]
            now = self.count[key]
            if now != c:
                if now:
                    heapq.heapreplace(self.heap, (-now, *self.heap[0][1:]))
                else:
                    heapq.heappop(self.heap)
                continue
            if c < self.floor or not self._certain(key, c):
                break
            l, r = key >> 32, key & 0xFFFFFFFF
            name = self.names[l] + self.names[r]
            m = self.ids.get(name)
            first, last = self.first.get(l, frozenset((l,))), self.last.get(r, frozenset((r,)))
            if m is None:
                m = self.ids[name] = len(self.names)
                self.names.append(name)
                self.first[m], self.last[m] = first, last
            else:
                self.first[m] = self.first.get(m, frozenset((m,))) | first
                self.last[m] = self.last.get(m, frozenset((m,))) | last
                self.origins = max(map(len, self.first.values())) * max(map(len, self.last.values()))
            self._merge(key, l, r, m)
            if len(self.first[m]) > 1 or len(self.last[m]) > 1:
                for other in self.pairs_of.get(m, ()):
                    heapq.heappush(self.loose, (-self._upper(other), other))
            out.append((l, r, m, c))
        return out

    def _merge(self, key, l, r, m):
        sym, nxt, prv = self.sym, self.nxt, self.prv
        p = np.unique(np.concatenate(self.at.pop(key)))
        p = p[(sym[p] == l) & (nxt[p] >= 0)]
        p = p[sym[nxt[p]] == r]
        if l == r:  # of overlapping pairs the left one
            chosen, taken = [], -1
            for x, y in zip(p.tolist(), nxt[p].tolist()):
                if x != taken:
                    chosen.append(x)
                    taken = y
            p = np.array(chosen, dtype=np.int64)
        q, a = nxt[p], prv[p]
        b = nxt[q]
        gone = np.unique(np.concatenate([a[a >= 0], p, q[b >= 0]]))
        for k, s in zip(*self._sums(gone)[:2]):
            self.count[k] -= s
        sym[p], sym[q], nxt[p] = m, -1, b
        prv[b[b >= 0]] = p[b >= 0]
        a = a[a >= 0]
        self._add(np.unique(np.concatenate([a[sym[a] >= 0], p[nxt[p] >= 0]])), heapq.heappush)


# ------------------------------------------------------------------ distributed parts of a round

#: words travel in blocks of about so many symbols, as three arrays in binary columns; Spark hands a task up to
#: 10,000 rows at once, so a block is small, and tasks work on several together
BLOCK, TOGETHER = 2_048, 65_536
BLOCKS = "flat binary, lens binary, weights binary"
#: entries that a task adds up before it passes them on
HELD = 1_000_000


def _block(flat: np.ndarray, lens: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in
                                       ((flat, "<i4"), (lens, "<i4"), (weights, "<i8"))], names=["flat", "lens", "weights"])


def _blocks(batches):
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(3))):
            held.append([x.as_py() for x in row])
            size += len(held[-1][0]) // 4
            if size >= TOGETHER:
                yield _together(held)
                held, size = [], 0
    if held:
        yield _together(held)


def _together(rows):
    return tuple(np.frombuffer(b"".join(x), dtype=t) for x, t in zip(zip(*rows), ("<i4", "<i4", "<i8")))


def _in_blocks(flat, lens, weights):
    """Blocks of about :data:`BLOCK` symbols; a word is not cut."""
    ends = np.cumsum(lens)
    part = (ends - 1) // BLOCK
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lens)]
    for a, b in zip(cuts, cuts[1:]):
        yield _block(flat[ends[a] - lens[a]:ends[b - 1]], lens[a:b], weights[a:b])


def _pair_keys(flat, lens):
    """Keys of neighbours and whether the two are in one word."""
    inner = np.ones(max(len(flat) - 1, 0), dtype=bool)
    inner[np.cumsum(lens)[:-1] - 1] = False
    wide = flat.astype(np.int64)
    return wide[:-1] << 32 | wide[1:], inner


def _sum_by(keys, weights):
    keys, inverse = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(keys), dtype=np.int64)
    np.add.at(sums, inverse, weights)
    return keys, sums


def _count_pairs(batches):
    """``pair, n``, summed up in the task."""
    held: list = []

    def flush():
        keys, sums = _sum_by(*(np.concatenate(x) for x in zip(*held)))
        held.clear()
        return keys, sums
    for flat, lens, weights in _blocks(batches):
        keys, inner = _pair_keys(flat, lens)
        held.append(_sum_by(keys[inner], np.repeat(weights, lens)[:-1][inner]))
        if sum(len(k) for k, _ in held) > HELD:
            held.append(flush())
            if len(held[0][0]) > HELD // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names=["pair", "n"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in flush()], names=["pair", "n"])


def _among(keys, table):
    """Which keys are in the sorted ``table``, which is not empty."""
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _chains_of(keys, inner, live):
    """Which symbols are in a chain (a maximal run of live pairs), which of those begin one, and which end one."""
    on = np.concatenate([[False], inner & _among(keys, live), [False]])
    member = on[1:] | on[:-1]
    return member, member & ~on[:-1], member & ~on[1:]


def _cut_chains(batches, live: np.ndarray):
    """``chain, n``: the chains (symbols as bytes) of all words, summed up in the task."""
    held: dict = {}

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["chain", "n"])
        held.clear()
        return out
    for flat, lens, weights in _blocks(batches):
        member, start, _ = _chains_of(*_pair_keys(flat, lens), live)
        data = memoryview(flat[member].tobytes())
        at = np.flatnonzero(start[member]) * 4
        for i, j, w in zip(at.tolist(), [*at[1:].tolist(), len(data)], np.repeat(weights, lens)[start].tolist()):
            key = bytes(data[i:j])
            held[key] = held.get(key, 0) + w
        if len(held) > HELD // 2:
            yield flush()
    if held:
        yield flush()


def _apply(batches, live: np.ndarray, merged: np.ndarray, result: dict):
    """The words with every changed chain replaced by its ``result``; ``merged`` are the pairs that make a chain change."""
    for flat, lens, weights in _blocks(batches):
        keys, inner = _pair_keys(flat, lens)
        _, start, end = _chains_of(keys, inner, live)
        begins, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        hit = np.flatnonzero(inner & _among(keys, merged))
        changed = np.unique(np.searchsorted(begins, hit, side="right") - 1)
        flat = flat.copy()
        for i, j in zip(begins[changed].tolist(), ends[changed].tolist()):
            new = result[flat[i:j].tobytes()]
            flat[i:i + len(new)] = new
            flat[i + len(new):j] = -1
        alive = flat >= 0
        left = np.add.reduceat(alive, np.cumsum(lens) - lens, dtype=np.int64)
        keep = left > 1
        if keep.any():
            yield from _in_blocks(flat[alive & np.repeat(keep, lens)], left[keep], weights[keep])


def _to_blocks(batches, ids: dict):
    """Symbol ids of the words; characters without an id cut a word."""
    flat, lens, weights = [], [], []
    for batch in batches:
        for word, c in zip(batch.column("word").to_pylist(), batch.column("count").to_pylist()):
            row: list = []
            for ch in [*(WORD_START + word), None]:
                i = ids.get(ch)
                if i is not None:
                    row.append(i)
                    continue
                if len(row) > 1:
                    flat += row
                    lens.append(len(row))
                    weights.append(c)
                row = []
            if len(flat) >= BLOCK:
                yield _block(*map(np.array, (flat, lens, weights)))
                flat, lens, weights = [], [], []
    if lens:
        yield _block(*map(np.array, (flat, lens, weights)))


def merge_table(merges) -> dict:
    """``(left, right, merged)`` in order of rank -> the table of :func:`merge_in_order`."""
    table: dict = {}
    for rank, (left, right, merged) in enumerate(merges):
        table.setdefault((left, right), ([], merged))[0].append(rank)
    return table


#: symbols of a word whose pairs are looked through at each merge
SHORT = 24


def _merge_short(sym: list, ranks: dict) -> list:
    done = -1
    while len(sym) > 1:
        best = pair = merged = None
        for p in zip(sym, sym[1:]):
            hit = ranks.get(p)
            if hit is not None:
                r = hit[0][0]
                if r <= done:
                    if hit[0][-1] <= done:
                        continue
                    r = hit[0][bisect_right(hit[0], done)]
                if best is None or r < best:
                    best, pair, merged = r, p, hit[1]
        if best is None:
            break
        done, (left, right) = best, pair
        out, k, last = [], 0, len(sym) - 1
        while k <= last:
            if k < last and sym[k] == left and sym[k + 1] == right:
                out.append(merged)
                k += 2
            else:
                out.append(sym[k])
                k += 1
        sym = out
    return sym


def merge_in_order(sym: list, ranks: dict) -> list:
    """``sym`` after all merges, applied in order of rank, each once, from left to right.

    ``ranks[left, right]`` is ``(its ranks ascending, merged)``; a pair has several where it was learned again."""
    n = len(sym)
    if n <= SHORT:
        return _merge_short(list(sym), ranks)
    sym, nxt, prv = list(sym), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i, above):
        if i >= 0 and nxt[i] < n:
            hit = ranks.get((sym[i], sym[nxt[i]]))
            if hit is not None and hit[0][-1] > above:
                heapq.heappush(heap, (hit[0][bisect_right(hit[0], above)], i, sym[i], sym[nxt[i]], hit[1]))
    for i in range(n - 1):
        offer(i, -1)
    while heap:
        rank, i, left, right, merged = heapq.heappop(heap)
        j = nxt[i]
        if sym[i] != left or j >= n or sym[j] != right:
            continue
        sym[i], sym[j], nxt[i] = merged, None, nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        offer(prv[i], rank)
        offer(i, rank)
    return [s for s in sym if s is not None]


def _round(state: DataFrame, names: list[str], limit: int, pairs: int, max_symbols: int):
    """The merges of a round, what :func:`_apply` needs for them, and the number of pairs that were live."""
    spark = state.sparkSession
    counts = materialize(state.mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "bpe-pairs")
    while True:
        # how many pairs have each of the highest counts: at most ``pairs`` rows matter, no pair is sorted
        levels = counts.groupBy("n").agg(F.count("*").alias("k")).orderBy(F.col("n").desc()).limit(pairs + 1).collect()
        if not levels:
            return [], None, pairs
        fit = np.searchsorted(np.cumsum([r["k"] for r in levels]), pairs, side="right")
        floor = 1 if fit == len(levels) else int(levels[fit]["n"]) + 1
        if fit:
            live = np.sort(counts.filter(F.col("n") >= floor).select("pair").toArrow().column("pair").to_numpy())
        else:  # more pairs share the highest count than may be live: the first of them alone
            floor, limit = int(levels[0]["n"]), 1
            live = np.array([_first_by_name(counts.filter(F.col("n") == floor), names)])
        sent = spark.sparkContext.broadcast(live)
        chains = state.mapInArrow(lambda b: _cut_chains(b, sent.value), "chain binary, n long").groupBy("chain").agg(F.sum("n").alias("n"))
        chains = materialize(chains, "bpe-chains")
        size = chains.agg(F.coalesce(F.sum(F.octet_length("chain")), F.lit(0))).first()[0] // 4
        if size <= max_symbols or len(live) == 1:
            break
        pairs = max(1, min(pairs, len(live)) // 4)
    table = chains.toArrow()
    texts = table.column("chain").to_pylist()
    flat, lens = np.frombuffer(b"".join(texts), dtype="<i4"), np.array([len(t) // 4 for t in texts])
    sim = _Chains(flat, lens, table.column("n").to_numpy(), names, floor)
    merges = sim.merges(limit)
    result = {}
    for t, end, size in zip(texts, np.cumsum(lens).tolist(), lens.tolist()):
        new = sim.sym[end - size:end]
        new = new[new >= 0]
        if len(new) < size:
            result[t] = new.astype(np.int32)
    merged = np.unique(np.array([l << 32 | r for l, r, *_ in merges], dtype=np.int64))
    return merges, spark.sparkContext.broadcast((live, merged, result)), pairs


def _first_by_name(pairs: DataFrame, names: list[str]) -> int:
    """The pair whose left and right symbols come first."""
    order = pairs.sparkSession.createDataFrame(list(enumerate(names)), "i long, name string")
    left, right = (order.select(F.col("i").alias(i), F.col("name").alias(c)) for i, c in (("l", "left"), ("r", "right")))
    ties = pairs.select("pair", F.shiftright("pair", 32).alias("l"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("r"))
    return ties.join(left, "l").join(right, "r").orderBy("left", "right").first()["pair"]


def train_bpe(words: DataFrame, num_merges: int, word_col: str = "word", count_col: str = "count",
              symbols: list[str] | None = None, max_symbols: int = MAX_SYMBOLS, max_pairs: int = MAX_PAIRS,
              materialize_every: int = 1) -> DataFrame:
    """Learn up to ``num_merges`` merges; returns ``(rank, left, right, piece, count)``.

    Stops early when no pair occurs any more.  ``symbols`` is the alphabet (default: all characters);
    the result does not depend on the bounds.  ``materialize_every`` is accepted for old callers: each round is written.
    """
    spark = words.sparkSession
    w = words.select(F.col(word_col).alias("word"), F.col(count_col).cast("long").alias("count"))
    names = list(symbols or alphabet(w))
    ids = {s: i for i, s in enumerate(names)}
    state = materialize(w.mapInArrow(lambda b: _to_blocks(b, ids), BLOCKS), "bpe-words")
    found, pairs = [], min(max_pairs, FIRST_PAIRS)
    while len(found) < num_merges:
        merges, change, pairs = _round(state, names, num_merges - len(found), pairs, max_symbols)
        if not merges:
            break
        found += [(names[l], names[r], names[m], c) for l, r, m, c in merges]
        if len(found) < num_merges:
            state = materialize(state.mapInArrow(lambda b, change=change: _apply(b, *change.value), BLOCKS), "bpe-words")
        pairs = min(max_pairs, 4 * pairs)
    rows = [(k, *m) for k, m in enumerate(found, 1)]
    return spark.createDataFrame(rows, "rank int, left string, right string, piece string, count long")


def bpe_vocab(words: DataFrame, merges: DataFrame, word_col: str = "word", count_col: str = "count",
              symbols: list[str] | None = None, byte_pieces: bool = False) -> DataFrame:
    """``(piece, id)``: specials, byte pieces if asked for, then the base symbols by (frequency desc, symbol), then merges by rank."""
    spark = words.sparkSession
    base = symbols or alphabet(words.select(F.col(word_col).alias("word"), F.col(count_col).alias("count")))
    pieces = [("<pad>", 0), ("<s>", 1), ("</s>", 2), ("<unk>", 3)]
    if byte_pieces:
        pieces += [(f"<0x{b:02X}>", UNK_ID + 1 + b) for b in range(256)]
    pieces += [(s, len(pieces) + k) for k, s in enumerate(base)]
    # two merges can produce the same string; the piece keeps its first (lowest) rank
    merged = merges.groupBy("piece").agg((F.min("rank") + F.lit(len(pieces) - 1)).cast("int").alias("id"))
    return spark.createDataFrame(pieces, "piece string, id int").unionByName(merged)


def _sent_merges(merges: DataFrame):
    """The table of the merges, bounded by the vocabulary, sent to the tasks."""
    rows = sorted(merges.collect(), key=lambda r: r["rank"])
    return merges.sparkSession.sparkContext.broadcast(merge_table((r["left"], r["right"], r["piece"]) for r in rows))


def segment_words(words: DataFrame, merges: DataFrame, word_col: str = "word") -> DataFrame:
    """``(word, pieces array<string>)`` for each distinct word, merges applied by rank."""
    bc = _sent_merges(merges)

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"word": pdf["word"],
                                "pieces": [merge_in_order([WORD_START, *w], bc.value) for w in pdf["word"]]})
    distinct = words.select(F.col(word_col).alias("word")).distinct()
    return distinct.mapInPandas(run, "word string, pieces array<string>")


def _piece_ids(vocab: DataFrame, byte_pieces: bool):
    """``(pieces of a word) -> ids``, with the vocabulary (bounded by its size) sent to the tasks."""
    first = UNK_ID + 257 if byte_pieces else UNK_ID + 1  # text may spell a special or a byte piece
    ids = {r["piece"]: r["id"] for r in vocab.select("piece", "id").filter(F.col("id") >= first).collect()}

    def of(piece: str) -> list[int]:
        i = ids.get(piece)
        if i is not None:
            return [i]
        # a piece of the word that is no vocabulary piece is a single character
        return [UNK_ID + 1 + b for b in piece.encode()] if byte_pieces else [UNK_ID]
    return of


def encode_subword(lines: DataFrame, merges: DataFrame, vocab: DataFrame, key_cols,
                   text_col: str = "line", out: str = "ids", byte_pieces: bool = False) -> DataFrame:
    """``(*key_cols, ids)``: subword ids of each line (blank lines give ``[]``).

    With ``byte_pieces`` (the vocabulary must have them) a character outside the vocabulary becomes the pieces of its UTF-8
    bytes; without, UNK.
    """
    ranks = _sent_merges(merges)
    of = _piece_ids(vocab, byte_pieces)

    def word_ids():
        return lambda word: [i for p in merge_in_order([WORD_START, *word], ranks.value) for i in of(p)]
    return encode_by_word(lines, key_cols, text_col, out, word_ids)


def decode_subword(tokens: DataFrame, vocab: DataFrame, key_cols, ids_col: str = "ids",
                   out: str = "text", keys_differ: bool = False) -> DataFrame:
    """Pieces concatenated as bytes, the word-start marker turned back into a space, stripped.

    Byte pieces (by spelling and id) give their byte; bytes that are no valid UTF-8 are left out, as the lenient decoder does.
    The vocabulary goes to the tasks; rows with one key make one row, place by place, and are looked for unless ``keys_differ``.
    """
    keys = list(key_cols)
    raw: dict = {}
    for r in vocab.select("piece", "id").filter(F.col("id") > 2).collect():
        raw.setdefault(r["id"], []).append(_raw_bytes(r["piece"], r["id"]))
    sent = vocab.sparkSession.sparkContext.broadcast({i: sorted(p) for i, p in raw.items()})

    def line_text():
        pieces = sent.value
        one = {i: b"".join(p) for i, p in pieces.items()}

        def of(rows):
            if len(rows) == 1:
                data = b"".join([one.get(i, b"") for i in rows[0] or ()])
            else:
                parts = [[pieces.get(i, []) for i in ids if i is not None and i > 2] for ids in rows if ids]
                data = b"".join([p for place in _interleave(parts) for p in place]) if parts else b""
            return data.decode("utf-8", "ignore").replace(WORD_START, " ").strip()
        return of
    rows = tokens.select(*keys, F.array(ids_col).alias("__rows")) if keys_differ else rows_by_key(tokens, ids_col, keys)
    return map_rows(rows, keys, out, ST.StringType(), line_text, lambda texts: pa.array(texts, pa.string()))


def _raw_bytes(piece: str | None, i: int) -> bytes:
    if piece is None:
        return b""
    if re.search(r"^<0x[0-9A-F]{2}>$", piece) and int(piece[3:5], 16) + UNK_ID + 1 == i:
        return bytes([int(piece[3:5], 16)])
    return piece.encode()


__all__ = ["train_bpe", "bpe_vocab", "segment_words", "encode_subword", "decode_subword", "alphabet", "merge_in_order"]
