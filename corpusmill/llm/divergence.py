"""How the term use of sources differs within a language: a K-squared quadtree over the group-term count matrix.

A group is a language and a source; its row of the matrix holds the counts of the terms that at least
``min_docs`` documents of the language use.  Each group gives each kept term the smoothed share
``p = 1 + floor(scale * (count + 1) / (N + V))``, also where the count is 0.  The divergence of group ``g`` from ``h``
is the sum of ``f = floor((p - q)^2 / q)`` over all kept terms.  All arithmetic is on integers.

1. Terms are counted per document batch in Arrow batches (a bounded table of counts, emptied when
   full) and summed by Spark; a hot group or term is a few rows a task by then.
2. Terms get dense columns per language, frequent ones first, by running sums over sampled ranges;
   groups get rows by source.  A cell is one nonzero count.
3. The tree: leaves are tiles of ``SIDE x SIDE`` cells, so at most ``SIDE^2`` nonzero ones are in
   an array; each node above has ``K x K`` children and a bit for each that is not all zero.
4. Joint traversal: from the root down, one step per level, for two row quadrants and a column
   quadrant.  Where both quadrants are zero the traversal ends: there every ``f`` of a pair is the
   same number, so they are priced by one multiplication at the end.  Where one is not zero it goes on.
5. At the leaves two tiles (or one and an empty one) give the sums of their pairs of rows in numpy, over the
   columns where at least one count is not zero; sums are added up in the task before they are shuffled.

Work is the number of tiles times the row blocks, as the result needs; memory per task is some tiles.

Nulls and edge cases: null text, language and source count as ``''``; a group without terms, or whose
language keeps no term, is kept (value 0 if no term is kept); a language with one source has no pairs; repeated rows and
repeated or null ids each count as a document; terms may be of any length; an empty table gives no rows; extra columns are
not read.  Counts are 64-bit; products are taken as decimals.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import range_prefix_sum
from ..sources.sinks import materialize

#: letters A-Z in either case and everything beyond ASCII, seen on UTF-8 bytes in lower case
TERM = re.compile(rb"[a-z\x80-\xff]+")
BREAK = re.compile(rb"[^a-z\x80-\xff]")
SCALE, MIN_DOCS, TOP = 1_000_000_000, 3, 200
#: rows and columns of a leaf tile; children of a node per side (K * K bits fit a long)
SIDE, K = 64, 8
#: bytes of counted terms that a task keeps before it passes them on, and of the table entry of a term besides its own
TABLE_BYTES, ENTRY_BYTES = 64 << 20, 250
#: bytes of a text that are searched at a time
PIECE = 1 << 20
TOP_SLICES = 32


def _pieces(data: bytes):
    """``data`` in pieces of about ``PIECE`` bytes that do not cut a term."""
    at = 0
    while at < len(data):
        cut = BREAK.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def _count_batches(batches):
    """``lang, source, term, n, df`` of some documents at a time; ``term`` null carries the number of documents."""
    counts: dict = {}
    held = 0

    def flush():
        for (lang, source), (uses, docs, n_docs) in counts.items():
            n = len(uses) + 1
            terms = pa.array([None, *uses], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n), terms,
                pa.array([0, *uses.values()], pa.int64()), pa.array([n_docs, *[docs[t] for t in uses]], pa.int64())],
                names=["lang", "source", "term", "n", "df"])
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            mine = counts.setdefault((lang.as_py(), source.as_py()), [Counter(), Counter(), 0])
            uses, docs = mine[:2]
            mine[2] += 1
            own: set = set()
            grown = 0
            for piece in _pieces(text.as_buffer().to_pybytes().lower()):
                terms = TERM.findall(piece)
                own.update(terms)
                before = len(uses)
                uses.update(terms)
                grown += len(uses) - before
            docs.update(own)
            # an upper bound of what the new terms take
            held += grown * ENTRY_BYTES + (min(sum(map(len, own)), grown * max(map(len, own))) if grown else 0)
            if held > TABLE_BYTES:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, term, n, df``: uses of each term in a group and documents with it; one row with a null
    term per group has its documents."""
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(o) for c, o in
                         ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    raw = rows.mapInArrow(_count_batches, "lang string, source string, term string, n long, df long")
    return raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + terms))``."""
    count, total, terms = (F.col(c) if isinstance(c, str) else c for c in (count, total, terms))
    wide = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    # counts whose product fits 64 bits need no decimals
    part = F.when(count < 2**32, F.call_function("div", (count + 1) * F.lit(SCALE).cast("long"), total + terms)).otherwise(
        F.call_function("div", wide, (total + terms).cast("decimal(20,0)")))
    return part + F.lit(1).cast("long")


def _f(p: str, q: str) -> Column:
    return F.call_function("div", (F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(q))


class Matrix:
    """The written tables of the count matrix.

    ``langs``: lang, rows; ``groups``: lang, source, r (row), total, terms (kept in the language), p0 (share of a zero count);
    ``cells``: lang, source, r, term, c (column), n, p, q (share in the language).
    """

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, **cols: str):
        counts = materialize(term_counts(docs, **cols), "term-counts")
        words = counts.filter(F.col("term").isNotNull())
        kept = (words.groupBy("lang", "term").agg(F.sum("n").alias("uses"), F.sum("df").alias("df"))
                .filter(F.col("df") >= min_docs))
        ranked = materialize(range_prefix_sum(kept, ["lang", F.col("uses").desc(), "term"],
                                              {"at": F.lit(1).cast("long")}, "term-order"), "terms")
        sums = ranked.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("uses").alias("lang_total"), F.min("at").alias("first"))
        cells = words.select("lang", "source", "term", "n").join(ranked.select("lang", "term", "uses", "at"), ["lang", "term"])
        cells = materialize(cells, "cells")
        group_sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        by_source = Window.partitionBy("lang").orderBy("source")
        groups = (counts.filter(F.col("term").isNull()).select("lang", "source")
                  .withColumn("r", F.row_number().over(by_source) - 1)
                  .join(group_sums, ["lang", "source"], "left").join(sums, "lang", "left")
                  .select("lang", "source", "r", F.coalesce("total", F.lit(0)).alias("total"),
                          F.coalesce("terms", F.lit(0)).alias("terms"), "lang_total", "first"))
        self.groups = materialize(groups.withColumn("p0", F.when(F.col("terms") > 0, _share(F.lit(0).cast("long"), "total", "terms"))), "groups")
        self.langs = self.groups.groupBy("lang").agg(F.count("*").alias("rows"))
        self.cells = materialize(
            cells.join(self.groups, ["lang", "source"])
            .select("lang", "source", "r", "term", (F.col("at") - F.col("first")).alias("c"), "n",
                    _share("n", "total", "terms").alias("p"), _share("uses", "lang_total", "terms").alias("q")), "matrix")


def _tree(matrix: Matrix, side: int, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """Leaf tiles ``lang, i, k, at, p`` (places ``side * x + y`` of the nonzero cells and their shares) and, from the leaves up, the nodes ``lang, i, k, bits`` of each level;
    bit ``fan * x + y`` says that the child in row ``x`` and column ``y`` is not all zero."""
    cell = F.struct((F.col("r") % side * side + F.col("c") % side).cast("int").alias("at"), "p")
    tiles = materialize(matrix.cells.groupBy("lang", F.floor(F.col("r") / side).alias("i"), F.floor(F.col("c") / side).alias("k"))
                        .agg(F.collect_list(cell).alias("cells"))
                        .select("lang", "i", "k", F.col("cells.at").alias("at"), F.col("cells.p").alias("p")), "tiles")
    levels, below = [], tiles.select("lang", "i", "k")
    while True:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (fan * (F.col("i") % fan) + F.col("k") % fan).cast("int"))
        up = materialize(below.groupBy("lang", F.floor(F.col("i") / fan).alias("i"), F.floor(F.col("k") / fan).alias("k"))
                         .agg(F.bit_or(bit).alias("bits")), "tree-level")
        levels.append(up)
        if not up.filter("i > 0 OR k > 0").limit(1).count():
            return tiles, levels
        below = up.select("lang", "i", "k")


def _joint_leaves(matrix: Matrix, levels: list[DataFrame], side: int, fan: int) -> DataFrame:
    """``lang, i, j, k`` with ``i <= j``: row blocks and column block where tile ``(i, k)`` or ``(j, k)`` is not all zero."""
    blocks = matrix.langs.select("lang", F.ceil(F.col("rows") / side).alias("blocks"))
    zero = F.lit(0).cast("long")
    front = levels[-1].select("lang", "i", F.col("i").alias("j"), "k")
    for depth in range(len(levels) - 1, -1, -1):
        node = levels[depth]
        own = front.join(node.withColumnRenamed("bits", "bi"), ["lang", "i", "k"], "left")
        own = own.join(node.select("lang", F.col("i").alias("j"), "k", F.col("bits").alias("bj")), ["lang", "j", "k"], "left")
        child = own.join(blocks, "lang").select("lang", "blocks", "i", "j", "k", F.coalesce("bi", zero).alias("bi"),
                                                F.coalesce("bj", zero).alias("bj"), F.explode(F.sequence(F.lit(0), F.lit(fan ** 3 - 1))).alias("w"))
        x, y, z = F.floor(F.col("w") / (fan * fan)), F.floor(F.col("w") / fan) % fan, F.col("w") % fan
        live = F.getbit("bi", (fan * x + z).cast("int")) + F.getbit("bj", (fan * y + z).cast("int")) > 0
        child = child.filter(live).select("lang", "blocks", (fan * F.col("i") + x).alias("i"), (fan * F.col("j") + y).alias("j"),
                                          (fan * F.col("k") + z).alias("k"))
        # rows of a node of this depth's children: fan^depth tiles
        width = fan ** depth
        front = materialize(child.filter((F.col("i") <= F.col("j")) & (F.col("j") * width < F.col("blocks")))
                            .select("lang", "i", "j", "k"), "joint-front")
    return front


def _tile_sums(frames, side: int):
    """Per pair of rows of two tiles: sum of ``f`` both ways over the columns that are not zero in both, and their number."""
    def dense(at, p, zeros):
        m = np.repeat(np.asarray(zeros, dtype=np.int64), side)
        hit = np.zeros(m.shape, dtype=bool)
        if at is not None:
            m[at] = p
            hit[at] = True
        return m.reshape(-1, side), hit.reshape(-1, side)

    for pdf in frames:
        held: dict = {}
        for lang, i, j, ata, pa_, atb, pb, za, zb in zip(*(pdf[c] for c in ("lang", "i", "j", "ata", "pa", "atb", "pb", "za", "zb"))):
            p, hp = dense(ata, pa_, za)
            q, hq = dense(atb, pb, zb)
            total = held.setdefault((lang, i, j), np.zeros((3, len(p), len(q)), dtype=np.int64))
            live = hp[:, None, :] | hq[None, :, :]  # at most side^3
            square = np.where(live, (p[:, None, :] - q[None, :, :]) ** 2, 0)
            total[0] += (square // q[None, :, :]).sum(axis=2)
            total[1] += (square // p[:, None, :]).sum(axis=2)
            total[2] += live.sum(axis=2)
        for (lang, i, j), t in held.items():
            g, h = np.meshgrid(np.arange(t.shape[1]) + i * side, np.arange(t.shape[2]) + j * side, indexing="ij")
            yield pd.DataFrame({"lang": lang, "g": g.ravel(), "h": h.ravel(), "gh": t[0].ravel(), "hg": t[1].ravel(), "seen": t[2].ravel()})


def pair_divergence(matrix: Matrix, side: int = SIDE, fan: int = K) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language, both ways."""
    tiles, levels = _tree(matrix, side, fan)
    front = _joint_leaves(matrix, levels, side, fan)
    zeros = (matrix.groups.filter("terms > 0").groupBy("lang", F.floor(F.col("r") / side).alias("i"))
             .agg(F.array_sort(F.collect_list(F.struct("r", "p0"))).alias("z"))
             .select("lang", "i", F.transform("z", lambda s: s["p0"]).alias("za")))
    both = (front.join(tiles.select("lang", "i", "k", F.col("at").alias("ata"), F.col("p").alias("pa")), ["lang", "i", "k"], "left")
            .join(tiles.select("lang", F.col("i").alias("j"), "k", F.col("at").alias("atb"), F.col("p").alias("pb")), ["lang", "j", "k"], "left")
            .join(zeros, ["lang", "i"]).join(zeros.select("lang", F.col("i").alias("j"), F.col("za").alias("zb")), ["lang", "j"])
            .select("lang", "i", "j", "ata", "pa", "atb", "pb", "za", "zb"))
    sums = both.mapInPandas(lambda frames: _tile_sums(frames, side), "lang string, g long, h long, gh long, hg long, seen long")
    sums = sums.filter("g < h").groupBy("lang", "g", "h").agg(*[F.sum(c).alias(c) for c in ("gh", "hg", "seen")])
    way = F.explode(F.array(F.struct(F.col("g").alias("r"), F.col("h").alias("s"), F.col("gh").alias("sum")),
                            F.struct(F.col("h").alias("r"), F.col("g").alias("s"), F.col("hg").alias("sum"))))
    sums = sums.select("lang", "seen", way.alias("w")).select("lang", "seen", "w.r", "w.s", "w.sum")
    other = matrix.groups.select("lang", F.col("source").alias("item"), F.col("r").alias("s"), F.col("p0").alias("q0"))
    pairs = matrix.groups.join(other, "lang").filter(F.col("r") != F.col("s")).join(sums, ["lang", "r", "s"], "left")
    rest = (F.col("terms") - F.coalesce("seen", F.lit(0))) * _f("p0", "q0")
    return pairs.select("lang", "source", "item", F.when(F.col("terms") > 0, F.coalesce("sum", F.lit(0)) + rest).otherwise(F.lit(0))
                        .cast("long").alias("value"))


def term_divergence(matrix: Matrix, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: the terms that a group uses more than its language, best first."""
    over = matrix.cells.filter(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), _f("p", "q").alias("value"))
    best = [F.col("value").desc(), F.col("item")]
    # a hot group is ranked in slices first, which leave at most top * TOP_SLICES terms
    part = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(TOP_SLICES))).orderBy(*best)
    some = over.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*best))).filter(F.col("rank") <= top)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, side: int = SIDE, fan: int = K, **cols: str) -> DataFrame:
    """``lang, source, part, item, value, rank``: pairs (part ``pair``) and over-used terms (part ``term``)."""
    matrix = Matrix(docs, min_docs, **cols)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = pair_divergence(matrix, side, fan).withColumn("rank", F.row_number().over(order))
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
           for df, part in ((pairs, "pair"), (term_divergence(matrix, top), "term"))]
    return out[0].unionByName(out[1])


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = """
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tok AS (SELECT lang, source, k, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
                                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM (SELECT *, row_number() OVER () AS k FROM d) x),
kept AS (SELECT lang, term, count(*) AS uses FROM tok GROUP BY 1, 2 HAVING count(DISTINCT k) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM tok GROUP BY ALL),
tot AS (SELECT lang, count(*) AS v, sum(uses) AS n FROM kept GROUP BY 1),
full_n AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n
           FROM g JOIN kept ON kept.lang = g.lang
           LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
p AS (SELECT f.lang, f.source, f.term, f.n,
             1 + (1000000000 * (f.n + 1)::HUGEINT) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + tot.v) AS p
      FROM full_n f JOIN tot ON tot.lang = f.lang),
q AS (SELECT kept.lang, kept.term, 1 + (1000000000 * (kept.uses + 1)::HUGEINT) // (tot.n + tot.v) AS q
      FROM kept JOIN tot ON tot.lang = kept.lang),
pair_sum AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair_sum s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q)) // q.q AS value
          FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 200
"""
