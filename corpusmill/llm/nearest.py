"""Nearest neighbours by inner product: a block matrix join of int8 tiles.

1. Vectors are dealt into blocks of bounded size (queries and candidates alike).  A block
   holds int8 codes with one scale per vector, the length of each code vector and of its
   rounding error, and the original floats.
2. Every (query block, candidate block) pair is a tile.  The product of the codes gives
   approximate inner products; by Cauchy-Schwarz the error is at most
   |q'||r_v| + |r_q||v| (codes q', errors r), so each pair has a lower and an upper bound.
   Pairs whose upper bound is below the k-th largest lower bound of their query in the
   tile cannot be among the k nearest and are pruned: the result is exact.
3. Surviving pairs are recomputed in double precision from the original vectors, by one fixed order of
   summation, and kept in a heap of k; tiles' heaps are merged, a bounded number of
   candidate blocks at a time, until one is left.

The work is the stated query set against all rows, in blocks.  No block grows with the data; the number of tiles does.

Nulls and edge cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null id, take no
part; vectors of another length than the query's are no candidates of it; rows that repeat an id are one candidate
(any of them; a query's own id is no candidate); ties go to the smaller id; fewer candidates than k give fewer rows; an
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
SUB = 512  # queries of a tile handled at once
FAN_IN = 16


def _usable(vec: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vec.isNotNull() & ~F.exists(vec, bad) & F.exists(vec, lambda x: x != 0)


def _block(pdf: pd.DataFrame) -> dict:
    vecs = np.array(pdf["vec"].tolist(), dtype=np.float64)
    scale = np.abs(vecs).max(axis=1) / 127.0
    scale[scale == 0] = np.finfo(np.float64).tiny
    codes = np.clip(np.rint(vecs / scale[:, None]), -127, 127).astype(np.int8)
    coded = codes * scale[:, None]
    return {"ids": pdf["id"].to_numpy(np.int64).tobytes(), "codes": codes.tobytes(), "scale": scale.tobytes(),
            "coded_len": np.linalg.norm(coded, axis=1).tobytes(), "error_len": np.linalg.norm(vecs - coded, axis=1).tobytes(),
            "vecs": vecs.tobytes()}


_BLOCK_SCHEMA = "dim int, block long, ids binary, codes binary, scale binary, coded_len binary, error_len binary, vecs binary"


def _pack(rows: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block of ``rows`` (id, vec)."""
    keyed = rows.select("id", "vec", F.size("vec").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(n_blocks)).alias("block"))

    def pack(key, pdf):
        return pd.DataFrame([{"dim": key[0], "block": key[1], **_block(pdf)}])

    return keyed.groupBy("dim", "block").applyInPandas(pack, _BLOCK_SCHEMA)


def _open(row, dim: int, side: str) -> dict:
    get = lambda c, t: np.frombuffer(row[f"{side}_{c}"], t)
    ids = get("ids", np.int64)
    return {"ids": ids, "codes": get("codes", np.int8).reshape(len(ids), dim).astype(np.float32), "scale": get("scale", "f8"),
            "coded_len": get("coded_len", "f8"), "error_len": get("error_len", "f8"), "vecs": get("vecs", "f8").reshape(len(ids), dim)}


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component to the last."""
    out = a[:, 0] * b[:, 0]
    for d in range(1, a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def tile_nearest(q: dict, c: dict, k: int):
    """(query index, candidate index, score) of each query's k nearest within a tile."""
    for at in range(0, len(q["ids"]), SUB):
        s = slice(at, at + SUB)
        # products of int8 codes are whole numbers below 2**24 for up to 1,040 components: exact in float32
        approx = (q["codes"][s] @ c["codes"].T).astype(np.float64) * q["scale"][s, None] * c["scale"][None, :]
        err = (q["coded_len"][s, None] * c["error_len"][None, :]
               + q["error_len"][s, None] * (c["coded_len"] + c["error_len"])[None, :])
        err += 1e-6 * (np.abs(approx) + err) + 1e-300
        own = q["ids"][s, None] == c["ids"][None, :]
        low = np.where(own, -np.inf, approx - err)
        n = low.shape[1]
        bar = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(low), -np.inf)
        i, j = np.nonzero((approx + err >= bar[:, None]) & ~own)
        score = inner(q["vecs"][s][i], c["vecs"][j])
        order = np.lexsort((c["ids"][j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, np.arange(len(low)))
        keep = np.arange(len(i)) - first[i] < k
        yield i[keep] + at, j[keep], score[keep]


_HEAP = "query_id long, part long, ids binary, scores binary"


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id, rank, id, score``: each query's ``k`` nearest candidates, exact."""
    def clean(df):
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
        return rows.filter(F.col("id").isNotNull() & _usable(F.col("vec"))).dropDuplicates(["id"])

    cands, quers = clean(vectors), clean(queries)
    sizes = [max(1, -(-n // b)) for n, b in ((queries.count(), query_block), (vectors.count(), candidate_block))]
    # hashed blocks vary a little in size; none grows with the data
    left, right = _pack(quers, sizes[0]), _pack(cands, sizes[1])
    name = lambda df, side: df.select("dim", *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != "dim"])
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = name(left, "q").withColumn("c_block", every(sizes[1]))
    right = name(right, "c").withColumn("q_block", every(sizes[0]))
    tiles = left.join(right, ["dim", "q_block", "c_block"])

    def run(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                q, c = _open(row, row["dim"], "q"), _open(row, row["dim"], "c")
                for i, j, score in tile_nearest(q, c, k):
                    cut = np.flatnonzero(np.diff(i)) + 1
                    rows = [(int(q["ids"][a[0]]), int(row["c_block"]), c["ids"][b].tobytes(), s.tobytes())
                            for a, b, s in zip(np.split(i, cut), np.split(j, cut), np.split(score, cut)) if len(a)]
                    yield pd.DataFrame(rows, columns=["query_id", "part", "ids", "scores"])

    heaps = tiles.mapInPandas(run, _HEAP)

    def merged(key, pdf):
        lists = [zip(-np.frombuffer(s, "f8"), np.frombuffer(i, "i8")) for i, s in zip(pdf["ids"], pdf["scores"])]
        best = [x for x, _ in zip(heapq.merge(*lists), range(k))]
        return (key[0], key[1], np.array([x[1] for x in best], "i8").tobytes(), np.array([-x[0] for x in best], "f8").tobytes())

    width = sizes[1]
    while width > 1:
        width = -(-width // FAN_IN)
        # queries of one bucket and up to FAN_IN parts meet; a group stays bounded as the data grows
        groups = heaps.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy(
            F.pmod(F.xxhash64("query_id"), F.lit(max(16, sizes[0] * 16))).alias("bucket"), "part")

        def merge_group(pdf):
            return pd.DataFrame([merged(key, g) for key, g in pdf.groupby(["query_id", "part"])],
                                columns=["query_id", "part", "ids", "scores"])

        heaps = groups.applyInPandas(merge_group, _HEAP)

    def rows(batches):
        for pdf in batches:
            for q, i, s in zip(pdf["query_id"], pdf["ids"], pdf["scores"]):
                ids, scores = np.frombuffer(i, "i8"), np.frombuffer(s, "f8")
                yield pd.DataFrame({"query_id": q, "rank": np.arange(1, len(ids) + 1, dtype=np.int32), "id": ids, "score": scores})

    return heaps.mapInPandas(rows, "query_id long, rank int, id long, score double")


def op9_nearest(spark, sf_dir: str) -> DataFrame:
    vecs = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = nearest(vecs, vecs.filter("vec_id % 20 = 0"))
    return out.withColumnRenamed("id", "vec_id")


OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q, v c
      WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
