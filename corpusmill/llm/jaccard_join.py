"""N-gram Jaccard join in the metric space of shingle sets, exact, with components.

A document's set holds its distinct five-word shingles.  1 - Jaccard is a metric; two
documents link when their distance is at most eps = 1 - threshold.

1. Documents with the same set are one point (node), so copies are never compared.
2. Outer regions: the pivots are the one-shingle sets.  A node's nearest pivots are its own
   shingles; with one global order of shingles for ties, a node that lies within eps of another can lack only
   so many of its shingles that their first ``n - ceil(threshold n) + 1`` nearest pivots have one in common.  The
   node is replicated into just those regions (its window).  The order puts shingles that are frequent in the
   whole sets of a sample last, the most frequent at the end, so crowded regions are rare; any order gives the same links.  Regions with one node end here (found by a
   map-side combined minimum and maximum, no region is ever gathered).
3. Regions of at most ``LEAF`` nodes compare them.  A crowded region takes its smallest node as pivot P; crowded regions with one pivot
   are one Voronoi region.  One of at most ``WHOLE`` shingles is compared as a whole: its nodes are dealt to blocks, and a task counts
   the overlaps of two blocks at once (tokens that many nodes share by a matrix product, the others by their lists of nodes) and
   passes on a spanning forest of the links.  In a larger region the distance of every node to P is measured on the whole sets.  For the pair (x, y)

       |x & y| <= min(|x & U|, |y & U|) + |(x - U) & (y - U)|

   where U joins the pivots on the way to the region.  As no node is smaller than P, x needs an overlap of
   ``need = threshold / (1 + threshold) * (|x| + |P|)`` at least with any other.  Nodes nearer than that (``|x & U| >= need``) are inner; right
   below the top they are those that link with P, hence connected.  A pair with a node that is not inner must share a shingle
   outside U, so the residual sets ``x - U`` get windows of their own, ``|x - U| - max(1, need - |x & U|) + 1`` shingles in the global order, and
   meet in new regions.  Further below, inner nodes that need not share one form a region without pivots.  A child region lacks the pivot, so
   the recursion ends; regions of one component end at once.
4. Pairs of small regions must pass the size bound min/max >= threshold and a bound from the number of regions they
   share; the others are verified on the whole sets, which are read once and kept by node; components are formed over the verified
   links by hooking and contraction, each round only over the labels that its new links connect.

Nulls and edge cases: a null text or a text without words has the empty set and links with nothing (its component
is its own id); a text of fewer words than five is one shingle; rows that repeat an id are rows of their own, with
the component of their set; null ids never name a component unless all its ids are null; an empty table gives an empty result.
Only id and text are read.  Shingles are 64-bit hashes of whole words; a word's hash joins a polynomial modulo 2**64 with one
modulo the prime 2**31 - 1, so that words built to agree in the first still differ.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import materialize

N_WORDS, THRESHOLD = 5, (80, 100)
LEAF = 256
BLOCK = 1 << 19  # shingles (a node counts as 256 at least) in a block, so at most 2,048 nodes
WHOLE = 8 * BLOCK  # shingles of a crowded region that is compared block by block
MAX_FREQUENT = 200_000  # shingles put last in the order; bounds what goes to the tasks
SAMPLE = 8  # one document in SAMPLE is looked at for them
HELD = 1_000_000  # shingles that a task counts before it passes them on
MAX_SMALL = 1_000_000  # ids sent to all tasks; more are joined by a shuffle
MAX_SMALL_BYTES = 32 << 20  # the same for sets of pivots
PIECE = 256  # rows of an output batch
BATCH_BYTES = 700_000
BATCH_ROWS = 1024  # sets, or pairs of them, that go to Python at a time
LISTED = 1 << 20  # places that a block pair counts at once

_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
for _a, _b in zip(range(65, 91), range(97, 123)):
    _BYTES[_a] = _BYTES[_b]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15 | 1
_INV = pow(_P, -1, 2**64)
_MIX = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0x9FB21C651E98DF25], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_PRIME = np.uint64(2**31 - 1)
_Q = 0x2545F491 % (2**31 - 1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64) for _ in range(4)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0..n-1 of a base and of its inverse modulo 2**64, and of another modulo the prime."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for k, base in enumerate((_P, _INV)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
        for k, base in ((2, _Q), (3, pow(_Q, -1, 2**31 - 1))):
            p = np.ones(1, np.uint64)
            while len(p) < size:  # base**len(p) times the powers so far
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 2**31 - 1)) % _PRIME])
            _POWERS[k] = p[:size]
    return [p[:n] for p in _POWERS]


def shingle_sets(texts: list[bytes], n_words: int = N_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = b" ".join(texts)
    if not raw:
        return [np.zeros(0, np.uint64) for _ in texts]
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse, power2, inverse2 = _powers(len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * power[:-1])])
    word = _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    # each term is below 2**62 before and 2**31 after the division, so the sum of a batch fits
    total = np.concatenate([[np.uint64(0)], np.cumsum((_BYTES[data] % _PRIME) * power2[:-1] % _PRIME)])
    word ^= _mix((total[end] - total[start]) % _PRIME * inverse2[start] % _PRIME)
    ends = np.cumsum([len(t) + 1 for t in texts])
    cut = np.searchsorted(start, ends)
    out, at = [], 0
    for stop in cut.tolist():
        w = word[at:stop]
        at = stop
        k = min(n_words, len(w))
        if not k:
            out.append(np.zeros(0, np.uint64))
            continue
        n = len(w) - k + 1
        s = w[:n] * _MIX[0]
        for j in range(1, k):
            s = s + w[j:j + n] * _MIX[j]
        out.append(np.unique(_mix(s)))
    return out


def batches_of(column, limit: int = BATCH_BYTES):
    """(first row, texts as UTF-8) in pieces of bounded size."""
    part, size, first = [], 0, 0
    for k in range(len(column)):
        t = (column[k].as_py() or "").encode("utf-8", "replace")
        part.append(t)
        size += len(t)
        if size >= limit:
            yield first, part
            part, size, first = [], 0, k + 1
    if part:
        yield first, part


def node_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


class Frequent(NamedTuple):
    """The shingles that come last in the global order, sorted, and their places there."""
    shingles: np.ndarray
    places: np.ndarray


def frequent_of(counts) -> Frequent:
    """Of ``(shingle, its number of sets)``, the most frequent at the end."""
    counts = sorted(counts, key=lambda r: (r[1], r[0]))
    shingles = np.array([r[0] for r in counts], np.int64).view(np.uint64)
    by_hash = np.argsort(shingles)
    return Frequent(shingles[by_hash], by_hash.astype(np.int32))


def prefix(s: np.ndarray, frequent: Frequent, threshold=THRESHOLD) -> np.ndarray:
    """The window of a set: its first shingles in the global order (frequent ones last)."""
    n = len(s)
    return first(s, n - -(-threshold[0] * n // threshold[1]) + 1, frequent)


def first(s: np.ndarray, k: int, frequent: Frequent) -> np.ndarray:
    """The first ``k`` shingles of a sorted set in the global order."""
    if k <= 0 or not len(frequent.shingles):
        return s[:max(k, 0)]
    at = np.minimum(np.searchsorted(frequent.shingles, s), len(frequent.shingles) - 1)
    last = frequent.shingles[at] == s
    seldom = s[~last]
    if len(seldom) >= k:
        return seldom[:k]
    return np.concatenate([seldom, s[last][np.argsort(frequent.places[at[last]])]])[:k]


def within(s: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which members of a sorted set are in another that is not empty."""
    return other[np.minimum(np.searchsorted(other, s), len(other) - 1)] == s


def _frequent(rows: DataFrame, n_words: int) -> Frequent:
    """Shingles that several sets of a sample of the documents have, counted in whole sets, equal sets once."""
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(SAMPLE)) == 0)

    def count(batches):
        held, size = [], 0
        for b in batches:
            for v in b.column("set"):
                held.append(np.frombuffer(v.as_py(), np.int64))
                size += len(held[-1])
                if size >= HELD:
                    yield _counted(held)
                    held, size = [], 0
        if held:
            yield _counted(held)

    sets = _sets(sample, n_words).dropDuplicates(["node"])
    often = (sets.select("set").mapInArrow(count, "t long, k long").groupBy("t").agg(F.sum("k").alias("k")).filter("k >= 2")
             .orderBy(F.desc("k"), "t").limit(MAX_FREQUENT).collect())
    return frequent_of([(r["t"], r["k"]) for r in often])


def _counted(sets: list[np.ndarray]) -> pa.RecordBatch:
    t, k = np.unique(np.concatenate(sets), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(t), pa.array(k)], ["t", "k"])


def _points(rows: DataFrame, frequent: Frequent, n_words: int, threshold) -> DataFrame:
    """``id, node, n, tokens`` of each row."""
    id_type = rows.schema["id"].dataType

    def run(batches):
        for b in batches:
            for first, texts in batches_of(b.column("text")):
                sets = shingle_sets(texts, n_words)
                yield pa.RecordBatch.from_arrays([
                    b.column("id").slice(first, len(texts)),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([prefix(s, frequent, threshold).view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["id", "node", "n", "tokens"])

    return rows.mapInArrow(run, f"id {id_type.simpleString()}, node long, n long, tokens array<long>")


def _sets(rows: DataFrame, n_words: int) -> DataFrame:
    """``one, node, set`` of each row with words."""
    def run(batches):
        for b in batches:
            for first, texts in batches_of(b.column("text")):
                sets = shingle_sets(texts, n_words)
                yield pa.RecordBatch.from_arrays([
                    b.column("id").slice(first, len(texts)), pa.array([node_of(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], ["one", "node", "set"])

    return rows.mapInArrow(run, f"one {dict(rows.dtypes)['id']}, node long, set binary")


def _small(df: DataFrame) -> DataFrame:
    """``df`` sent to all tasks if it is counted to be small."""
    return F.broadcast(df) if df.count() <= MAX_SMALL else df


def node_sets(nodes: DataFrame, rows: DataFrame, points: DataFrame, n_words: int) -> DataFrame:
    """``node, set`` of the nodes, from the whole text of one row each."""
    # ids that other texts repeat are sorted out by the node
    one = points.join(nodes, "node").groupBy("node").agg(F.min("id").alias("one"))
    one = materialize(one, "jaccard-nodes")
    ids = _small(one.select("one").distinct())
    texts = rows.join(ids, rows["id"].eqNullSafe(ids["one"]), "left_semi")
    sets = _sets(texts, n_words)
    want = _small(one.select(F.col("node").alias("w"), F.col("one").alias("o")))
    sets = sets.join(want, (sets["node"] == want["w"]) & sets["one"].eqNullSafe(want["o"]), "left_semi")
    # rows that repeat an id and a text give a node more than once
    return materialize(sets.groupBy("node").agg(F.max("set").alias("set")), "jaccard-sets")


def verify(pairs: DataFrame, sets: DataFrame, threshold) -> DataFrame:
    """The pairs ``a, b`` that link, by their whole sets."""
    num, den = threshold
    both = (pairs.join(sets.withColumnRenamed("node", "a").withColumnRenamed("set", "sa"), "a")
            .join(sets.withColumnRenamed("node", "b").withColumnRenamed("set", "sb"), "b"))

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                keep.append(int(within(p, q).sum()) * (num + den) >= (len(p) + len(q)) * num)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    rows, cols = len(left), len(right)
    total = np.zeros(rows * cols, np.float32)
    lt, rt = np.concatenate(left), np.concatenate(right)
    li, ri = np.repeat(np.arange(rows), [len(s) for s in left]), np.repeat(np.arange(cols), [len(s) for s in right])
    names = np.intersect1d(lt, rt)
    if not len(names):
        return total.reshape(rows, cols)
    keep = within(lt, names)
    lt, li = np.searchsorted(names, lt[keep]), li[keep]
    keep = within(rt, names)
    rt, ri = np.searchsorted(names, rt[keep]), ri[keep]
    lk, rk = np.bincount(lt, minlength=len(names)), np.bincount(rt, minlength=len(names))
    # a column of the product costs as much as some rows * cols / 200 places of lists
    dense = lk * rk * 200 > rows * cols
    place = np.cumsum(dense) - 1
    step = 1024
    for at in range(0, int(dense.sum()), step):
        sides = []
        for t, i, n in ((lt, li, rows), (rt, ri, cols)):
            mine = dense[t] & (place[t] >= at) & (place[t] < at + step)
            m = np.zeros((n, step), np.float32)
            m[i[mine], place[t[mine]] - at] = 1
            sides.append(m)
        total += (sides[0] @ sides[1].T).ravel()
    mine = ~dense[lt]
    lt, li = lt[mine], li[mine]
    order = np.argsort(rt, kind="stable")
    ri, begin, often = ri[order], np.cumsum(rk) - rk, rk[lt]
    ends = np.cumsum(often)
    at = 0
    while at < len(lt):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LISTED, "right")))
        k = often[at:stop]
        nth = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        total += np.bincount(np.repeat(li[at:stop], k) * cols + ri[np.repeat(begin[lt[at:stop]], k) + nth], minlength=rows * cols)
        at = stop
    return total.reshape(rows, cols)


def spanning(link: np.ndarray) -> list[tuple[int, int]]:
    """Of the links between rows and columns, as many as connect the same ones."""
    out, rows_left, cols_left = [], link.any(axis=1), np.ones(link.shape[1], bool)
    for start in np.flatnonzero(rows_left).tolist():
        if not rows_left[start]:
            continue
        rows_left[start] = False
        todo = [start]
        while todo:
            r = todo.pop()
            for c in np.flatnonzero(link[r] & cols_left).tolist():
                cols_left[c] = False
                out.append((r, c))
                for other in np.flatnonzero(link[:, c] & rows_left).tolist():
                    rows_left[other] = False
                    out.append((other, c))
                    todo.append(other)
    return out


def block_links(regions: DataFrame, sets: DataFrame, threshold, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that connect whatever links inside each region of ``regions (next, node, n)``; a region is of bounded size."""
    num, den = threshold
    weight = F.greatest("n", F.lit(256))
    order = Window.partitionBy("next").orderBy("n", "node").rowsBetween(Window.unboundedPreceding, 0)
    dealt = regions.withColumn("block", F.floor((F.sum(weight).over(order) - 1) / block).cast("int"))
    dealt = dealt.withColumn("last", F.max("block").over(Window.partitionBy("next")))
    each = dealt.select("next", "node", "block", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    each = each.select("next", "node", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    each = each.join(sets, "node")

    def run(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        nodes = table.column("node").to_numpy()
        data = [np.frombuffer(v.as_py(), np.uint64) for v in table.column("set")]
        first, second = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks == blocks.max())
        left, right = [data[i] for i in first], [data[i] for i in second]
        sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
        link = overlaps(left, right) * (num + den) >= sizes * num
        edges = [(nodes[first[i]], nodes[second[j]]) for i, j in spanning(link) if first[i] != second[j]]
        return pa.table([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return each.groupBy("next", "p", "q").applyInArrow(run, "a long, b long")


def pivot_sets(crowded: DataFrame, above: DataFrame | None, sets: DataFrame) -> DataFrame:
    """``next, pivot, pset, uset``: the set of each crowded region's pivot, and its union with those of the pivots above.

    ``next`` names the pivots so far in any order; regions that come to the same ones by other ways are one.
    """
    heads = crowded.filter("node = pivot").select("next", "path", "pivot")
    heads = heads.join(sets.select(F.col("node").alias("pivot"), F.col("set").alias("pset")), "pivot")
    if above is None:
        return heads.select("next", "pivot", "pset", F.col("pset").alias("uset"))
    old = above.dropDuplicates(["next"]).select(F.col("next").alias("path"), F.col("uset").alias("old"))
    heads = heads.join(old, "path", "left").select("next", "pivot", "pset", "old")

    def run(batches):
        for b in batches:
            new = [p.as_py() if not old.is_valid else
                   np.union1d(np.frombuffer(p.as_py(), np.uint64), np.frombuffer(old.as_py(), np.uint64)).tobytes()
                   for p, old in zip(b.column("pset"), b.column("old"))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("next", "pivot", "pset")), pa.array(new, pa.binary())],
                                             ["next", "pivot", "pset", "uset"])

    return heads.mapInArrow(run, "next long, pivot long, pset binary, uset binary")


def residual_windows(members: DataFrame, frequent: Frequent, threshold) -> DataFrame:
    """``next, pivot, node, n, linked, inner, tokens`` of the nodes (``set``) of crowded regions (``pset``, ``uset``)."""
    num, den = threshold

    def one(x: np.ndarray, p: np.ndarray, u: np.ndarray):
        n, inside = len(x), within(x, u)
        linked = int(within(x, p).sum()) * (num + den) >= (n + len(p)) * num
        need = max(-(-num * n // den), -(-num * (n + len(p)) // (num + den)))
        rest, known = x[~inside], int(inside.sum())
        return linked, known >= need, first(rest, len(rest) - max(1, need - known) + 1, frequent).view(np.int64)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                b = batch.slice(at, PIECE)
                got = [one(*(np.frombuffer(v.as_py(), np.uint64) for v in row))
                       for row in zip(b.column("set"), b.column("pset"), b.column("uset"))]
                linked, inner, tokens = zip(*got)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in ("next", "pivot", "node", "n")), pa.array(linked, pa.bool_()), pa.array(inner, pa.bool_()),
                     pa.array(tokens, pa.list_(pa.int64()))], ["next", "pivot", "node", "n", "linked", "inner", "tokens"])

    return members.mapInArrow(run, "next long, pivot long, node long, n long, linked boolean, inner boolean, tokens array<long>")


def components_of(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``edges (a, b)``; the label is a node of the component.

    Each node hooks to its smallest neighbour, if that is smaller; pointers are doubled down to the roots, and
    the edges between different roots are the next round's.
    """
    edges = materialize(edges.filter("a <> b").distinct(), "links-edges")
    labels = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("b")), "links-up")
        moved = True
        while moved:
            top = up.select(F.col("a").alias("b"), F.col("b").alias("top"))
            up = materialize(up.join(top, "b").select("a", F.col("top").alias("b"), (F.col("b") != F.col("top")).alias("moved")), "links-up")
            moved = up.filter("moved").limit(1).count() > 0
        root = up.select(F.col("a").alias("label"), F.col("b").alias("root"))
        if labels is None:
            labels = root.select(F.col("label").alias("node"), F.col("root").alias("label"))
        else:
            labels = labels.join(root, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
        labels = materialize(labels, "links-labels")
        edges = (edges.join(root.select(F.col("label").alias("a"), F.col("root").alias("x")), "a")
                 .join(root.select(F.col("label").alias("b"), F.col("root").alias("y")), "b"))
        edges = materialize(edges.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links-edges")
    return labels


def relabel(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """``labels`` after new links ``a, b``; nodes without links have none."""
    if labels is None:
        return components_of(links)
    for end in "ab":
        links = links.join(labels.select(F.col("node").alias(end), F.col("label").alias("l" + end)), end, "left")
    links = materialize(links.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a <> b").distinct(), "jaccard-joined")
    if not links.limit(1).count():
        return labels
    roots = components_of(links)
    # a label is itself a node with that label, so other nodes are new
    fresh = roots.select("node").join(labels.select("node"), "node", "left_anti").withColumn("label", F.col("node"))
    moved = labels.unionByName(fresh).join(roots.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
    return materialize(moved.select("node", F.coalesce("root", "label").alias("label")), "jaccard-labels")


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Batches of at most ``rows`` rows go to Python: one of sets, whose rows are of some KB, takes some MB instead of tens."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(old)) if int(old) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = N_WORDS,
                       threshold=THRESHOLD, leaf: int = LEAF, whole: int = WHOLE) -> DataFrame:
    """``id, n_shingles, component_id`` of each row; ``threshold`` is a fraction (numerator, denominator)."""
    with small_batches(docs.sparkSession):
        out = _components(docs, id_col, text_col, n_words, threshold, leaf, whole=whole)
    return out.select("id", "n_shingles", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, n_words: int = N_WORDS, threshold=THRESHOLD, leaf: int = LEAF,
                trace: list | None = None, whole: int = 0) -> DataFrame:
    """``id, node, n_shingles, label, component_id`` of each row; label is a node of the component, null as node without words.

    ``whole`` bounds the shingles of a crowded region that is compared block by block.
    ``trace`` gets for each round the rows of its regions, the pairs compared and the distances to pivots measured.
    """
    num, den = threshold
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    frequent = _frequent(rows, n_words)
    points = materialize(_points(rows, frequent, n_words, threshold), "jaccard-points")
    spread = points.filter("n > 0").select("node", "n", F.explode("tokens").alias("cell"))
    shared = spread.groupBy("cell").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
    regions = spread.join(shared.select("cell"), "cell").groupBy("cell", "node").agg(F.max("n").alias("n"))
    regions = materialize(regions.withColumns({"path": F.lit(0).cast("long"), "label": F.col("node")}), "jaccard-regions")
    close = lambda x, y: F.least(x, y) * den >= F.greatest(x, y) * num  # noqa: E731  no pair of sizes further apart links
    labels = above = sets = None
    while regions.limit(1).count():
        # regions whose nodes are connected end; the pivot is the smallest node
        heads = regions.groupBy("cell").agg(F.count("*").alias("size"), F.min("label").alias("l0"), F.max("label").alias("l1"),
                                            F.min(F.struct("n", "node")).alias("head")).filter("l0 <> l1")
        live = materialize(regions.join(heads.select("cell", "size", F.col("head.node").alias("pivot")), "cell"), "jaccard-members")
        own = live.filter(F.col("size") <= leaf).select("cell", "node", "n", "label")
        other = own.select("cell", F.col("node").alias("y"), F.col("n").alias("m"), F.col("label").alias("yl"))
        each = own.join(other, (own["cell"] == other["cell"]) & (own["node"] < other["y"])
                        & close(own["n"], other["m"]) & (own["label"] != other["yl"]))
        cand = each.groupBy(F.col("node").alias("a"), F.col("y").alias("b")).agg(
            F.count("*").alias("met"), F.max(F.col("n") + F.col("m")).alias("both"), F.max(F.greatest("n", "m")).alias("most"))
        if sets is None:
            # first round: the small regions a pair shares, and the crowded ones it may share, are all
            # the shingles common to both windows; beyond the shorter-reaching window at most
            # ceil(threshold n) - 1 more can be common
            crowd = live.filter(F.col("size") > leaf).groupBy("node").agg(F.count("*").alias("k"))
            cand = (cand.join(crowd.select(F.col("node").alias("a"), F.col("k").alias("ka")), "a", "left")
                    .join(crowd.select(F.col("node").alias("b"), F.col("k").alias("kb")), "b", "left"))
            may = F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0)))
            reach = F.ceil(F.col("most") * num / den - 1e-9) - 1
            cand = cand.filter((F.col("met") + may + reach) * (num + den) >= F.col("both") * num)
        cand = materialize(cand.select("a", "b"), "jaccard-pairs")
        crowded = live.filter(F.col("size") > leaf).select(
            F.col("path").bitwiseXOR(F.xxhash64("pivot")).alias("next"), "path", "pivot", "node", "n").distinct()
        crowded = materialize(crowded, "jaccard-crowded")
        if sets is None:
            # later rounds meet no other nodes than those of crowded regions
            need = cand.select(F.col("a").alias("node")).union(cand.select("b")).union(crowded.select("node")).distinct()
            sets = node_sets(need, rows, points, n_words)
        # regions of bounded size end here, all their pairs compared; crowded keeps the others
        weights = materialize(crowded.groupBy("next").agg(F.sum(F.greatest("n", F.lit(256))).alias("weight")), "jaccard-weights")
        done = weights.filter(F.col("weight") <= whole).select("next")
        ended = crowded.join(done, "next", "left_semi").select("next", "node", "n").distinct()
        crowded = crowded.join(done, "next", "left_anti")
        above = materialize(pivot_sets(crowded, above, sets), "jaccard-pivots")
        size = above.agg(F.sum(F.length("pset") + F.length("uset"))).first()[0] or 0
        members = crowded.filter("node <> pivot").join(sets, "node")
        members = members.join(F.broadcast(above) if size <= MAX_SMALL_BYTES else above, ["next", "pivot"])
        found = materialize(residual_windows(members, frequent, threshold), "jaccard-windows")
        links = verify(cand, sets, threshold).unionByName(found.filter("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        if whole:
            links = links.unionByName(block_links(ended, sets, threshold))
        links = materialize(links, "jaccard-links")
        if trace is not None:
            trace.append((live.count(), cand.count(), found.count()))
        if links.limit(1).count():
            labels = relabel(labels, links)
        if labels is not None:
            found = found.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        else:
            found = found.withColumn("label", F.col("node"))
        spread = found.select("next", "node", "n", "label", F.explode("tokens").alias("t"))
        spread = spread.select(F.xxhash64("next", "t").alias("cell"), "node", "n", F.col("next").alias("path"), "label")
        # right below the top inner nodes are linked with their pivot
        inner = found.filter("inner and not linked").select("next").distinct()
        inner = found.filter("inner").join(inner, "next", "left_semi")
        spread = spread.unionByName(inner.select(F.xxhash64("next", F.lit("inner")).alias("cell"), "node", "n",
                                                 F.lit(0).cast("long").alias("path"), "label"))
        shared = spread.groupBy("cell").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 <> l1")
        regions = materialize(spread.join(shared.select("cell"), "cell").distinct(), "jaccard-regions")
    nodes = points.filter("n > 0").groupBy("node").agg(F.min("id").alias("low"))
    if labels is not None:
        nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        heads = nodes.groupBy("label").agg(F.min("low").alias("component_id"))
        nodes = nodes.join(heads, "label")
    else:
        nodes = nodes.withColumns({"label": F.col("node"), "component_id": F.col("low")})
    out = points.select("id", "node", "n").join(nodes.select("node", "label", "component_id"), "node", "left")
    return out.select("id", "node", F.col("n").alias("n_shingles"), "label",
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _with_node(docs: DataFrame, text_col: str, n_words: int) -> DataFrame:
    """``docs`` with ``__node``, null for texts without words."""
    def run(batches):
        for b in batches:
            for first, texts in batches_of(b.column(text_col)):
                nodes = [node_of(s) if len(s) else None for s in shingle_sets(texts, n_words)]
                yield pa.RecordBatch.from_arrays([*b.slice(first, len(texts)).columns, pa.array(nodes, pa.int64())],
                                                 [*b.schema.names, "__node"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())]))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = N_WORDS, whole: int = WHOLE,
                     **args) -> DataFrame:
    """One row of each component, and all rows without words.

    The row with the smallest id stays (a null id comes last; of texts with one id that with the smallest node; of rows that
    have both in common that with the smallest text).  Rows go by id and node, so an id that other texts
    repeat, or null, takes no other row along.
    """
    with small_batches(docs.sparkSession):
        comp = materialize(_components(docs, id_col, text_col, n_words, whole=whole, **args), "jaccard-components")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    heads = comp.filter("n_shingles > 0").groupBy("label").agg(F.min(rank).alias("head"))
    heads = materialize(heads.select("label", F.col("head.id").alias("hid"), F.col("head.node").alias("hnode")), "jaccard-heads")
    lost = comp.join(heads, "label").filter(~(F.col("id").eqNullSafe(F.col("hid")) & (F.col("node") == F.col("hnode"))))
    # an id with one row goes by itself; the rows of others are told apart by their nodes
    shared = materialize(comp.groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1").select("id"), "jaccard-shared")
    gone = lost.select(F.col("id").alias("__id")).unionByName(shared.select(F.col("id").alias("__id"))).distinct()
    out = docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]), "left_anti")
    if not shared.limit(1).count():
        return out
    some = _with_node(docs.join(shared, docs[id_col].eqNullSafe(shared["id"]), "left_semi"), text_col, n_words)
    kept = some.join(heads, some[id_col].eqNullSafe(heads["hid"]) & (some["__node"] == heads["hnode"]), "left_semi")
    kept = kept.groupBy(id_col, "__node").agg(F.min_by(F.struct(*docs.columns), text_col).alias("__row")).select("__row.*")
    return out.unionByName(kept).unionByName(some.filter("__node is null").drop("__node"))


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs).withColumnRenamed("id", "doc_id")
