"""Shards of nearly equal bytes: the minimax contiguous partition of ordered atomic groups (DataFrame operations only).

Equal texts form an atomic group that is never divided.  Groups stand in the order of their digests,
behind those that alone exceed a fair share of all bytes (fewer than there are shards, largest first).
Shards are contiguous runs of that order:

1. Running byte sums of the ordered groups, over sampled ranges, written once.
2. The smallest feasible capacity (largest shard) is searched between the larger of a fair share and
   the largest group, and a fair share plus the largest group, which always suffices.  A capacity is
   checked greedily: each shard takes all groups that fit.  A round checks :data:`PROBES` capacities
   at once, one filtered aggregate over the sums per shard, and narrows the interval by that factor.
3. Any cut works that lies between the greedy cuts from the right and the capacity from the left.
   Each shard ends as near below its share of what is left as those allow, so that a hot group, which
   fixes the capacity, does not empty the other shards.
4. The cuts are a few order keys.  A document compares its digest with them; no join is needed,
   and a group of any number of copies stays spread over all tasks.
5. Slots number the rows of a shard by digest, id and input partition, over sampled ranges of that order,
   so a hot group is divided there as well.

Driver state: :data:`PROBES` numbers, and one key per shard.

Nulls and edge cases: a null text counts as empty and is in the group of empty texts, size 1; rows with
null or repeated ids, and rows that repeat altogether, are each placed (null ids first within a group); an empty
table gives no rows; with fewer groups than shards the last shards stay empty; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import range_prefix_sum
from ..sources.sinks import materialize

#: capacities checked in one round of the search
PROBES = 64


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("crc"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.spark_partition_id().alias("piece"))


class _Sums:
    """Running sums at the ends of the ordered groups, as a table; 0 is the start."""

    def __init__(self, ends: DataFrame, largest: int):
        self.ends, self.largest = ends, largest

    def last_within(self, limits: list[int]) -> list[int]:
        """For each limit the last end not above it (0 if none).  The end is less than one group away."""
        near = self.ends.filter(F.col("end").between(min(limits) - self.largest, max(limits)))
        # an array of limits is data to the generated code, which is then the same for all rounds
        order = sorted(set(limits))
        array = F.expr("array(" + ",".join(f"{x}L" for x in order) + ")")
        below = F.size(F.filter(array, lambda x: x < F.col("end")))
        best = {r["k"]: r["end"] for r in near.groupBy(below.alias("k")).agg(F.max("end").alias("end")).collect()}
        found, last = {}, 0
        for k, x in enumerate(order):
            found[x] = last = best.get(k, last)
        return [found[x] for x in limits]

    def first_from(self, limit: int) -> int:
        """The first end that is ``limit`` or more (0 for limits up to 0)."""
        near = F.col("end").between(limit, limit + self.largest)
        return self.ends.filter(near).agg(F.min("end")).first()[0] if limit > 0 else 0


def minimax_cuts(sums: _Sums, total: int, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the ends of the shards (running sums; the last is ``total``)."""
    fair = -(-total // shards)
    low, high = max(fair, sums.largest), fair + sums.largest  # high is feasible
    while low < high:
        step = max(1, -(-(high - low) // PROBES))
        probes = list(range(low, high, step))
        reach = [0] * len(probes)
        for _ in range(shards):
            reach = sums.last_within([r + c for r, c in zip(reach, probes)])
        good = next((i for i, r in enumerate(reach) if r >= total), len(probes))
        # the smallest feasible capacity lies above the last probe that failed
        low, high = (probes[good - 1] + 1 if good else low), (probes[good] if good < len(probes) else high)
    least = [total]  # from the right: the least end that each shard may have
    for _ in range(shards - 1):
        least.insert(0, sums.first_from(least[0] - low))
    ends, start = [], 0
    for k in range(shards - 1):
        want = max(least[k], start + (total - start) // (shards - k))
        end = sums.last_within([want])[0]
        if end <= start < total:  # no group fits the share: one group
            end = sums.first_from(start + 1)
        ends.append(max(end, start))
        start = ends[-1]
    return low, [*ends, total]


def _place(cuts: list[tuple[int, bytes]], big: dict[bytes, int], digest: Column) -> Column:
    """Shard number of a digest: one of the few big groups, or the run of digests it falls in."""
    place = F.lit(0)
    for k, last in cuts:  # ascending: shard k + 1 starts behind digest ``last``
        place = F.when(digest > F.lit(last), F.lit(k + 1)).otherwise(place)
    for d, k in big.items():
        place = F.when(digest == F.lit(d), F.lit(k)).otherwise(place)
    return place.cast("int")


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, size, crc, digest, shard, slot``, equal texts in one shard."""
    rows = materialize(_rows(docs, id_col, text_col), "shard-rows")  # texts are read once
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    total, largest = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    if total is None:
        return rows.select("id", "size", "crc", "digest", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    over = F.greatest(F.col("bytes") - -(-total // shards), F.lit(0))
    ordered = range_prefix_sum(groups.withColumn("over", over), [F.col("over").desc(), "digest"], {"start": "bytes"},
                               "shard-order")
    sums = materialize(ordered.select("over", "digest", F.col("start"), (F.col("start") + F.col("bytes")).alias("end")),
                       "shard-sums")
    _, ends = minimax_cuts(_Sums(sums, largest), total, shards)
    shard_of = sum((F.when(F.col("start") >= e, 1).otherwise(0) for e in ends[:-1]), F.lit(0))
    # fewer groups than shards exceed a fair share
    big = {bytes(r["digest"]): r["shard"] for r in
           sums.filter("over > 0").select("digest", shard_of.alias("shard")).collect()}
    lasts = {r["end"]: bytes(r["digest"]) for r in sums.filter(F.col("end").isin(ends) & (F.col("over") == 0)).collect()}
    # a cut among the big groups stands before all digests
    cuts = [(k, lasts.get(e, b"")) for k, e in enumerate(ends[:-1]) if e < total]
    placed = rows.withColumn("shard", _place(cuts, big, F.col("digest")))
    spot = range_prefix_sum(placed, ["shard", "digest", "id", "piece"], {"place": F.lit(1).cast("long")}, "shard-slots")
    starts = F.lit(0).cast("long")
    before = 0
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    for k in range(shards):
        starts = F.when(F.col("shard") == k, F.lit(before)).otherwise(starts)
        before += counts.get(k, 0)
    return spot.select("id", "size", "crc", "digest", "shard", (F.col("place") - starts).alias("slot"))


def op12_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
