"""Mixing sources to target weights as a time-varying curriculum (DataFrame operations only).

* Targets: sources share ``share`` times all words by weight; a target stops at
  ``max_epochs`` times its source's size and the excess is shared again by weight until
  none is above.  That fixed point is found in one pass: ordered by cap / weight, the
  capped sources are a prefix, recognised from running sums of caps and weights.
* Take: the documents of a source stand in a seeded hash order; the mix takes the first
  ``target`` words of that order repeated ``max_epochs`` times, so the last document taken
  may be cut (its first words are taken) and every source meets its target to the word.
* Curriculum: each source has a piecewise-linear weight schedule over training time 0..1.
  Its integral, scaled to the target, is the source's cumulative token demand; inverting it
  at a document's token offset gives the document's training position, and the documents
  are range-sorted by position.

A third of all rows may belong to one source: sources are aggregated map-side, and the
running sums go by sampled ranges of (source, hash), which split a hot source.

Nulls and edge cases: a null text has size 0; the null source is a source of its own that
comes last; sources without words get the target 0; a null id is hashed as the word null;
rows that repeat an id and a text are separate rows, and which of them comes first makes no
difference to the result as a whole; an empty table gives an empty result.  Only id, text and source are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import range_prefix_sum
from ..sources.sinks import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: knots (time, weight) by weight class: steady, fading out, coming in
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)))
SEED = 17


def source_targets(sizes: DataFrame, share: float = 1.5, max_epochs: int = 2,
                   weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``source, source_size, source_start, class, target`` from rows ``source, source_size``.

    ``source_start`` is the number of words of all sources that come before by code point.
    """
    n = len(weights)
    ranked = range_prefix_sum(sizes, [F.col("source").asc_nulls_last()],
                              {"source_start": "source_size", "rank": F.lit(1)}, "mix-sources")
    ranked = ranked.withColumn("class", (F.col("rank") % n).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("class") + 1)
    ranked = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * float(max_epochs)})
    ranked = materialize(ranked.withColumn("ratio", F.col("cap") / F.col("weight")), "mix-ranked")
    tot = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, all_weight = share * (tot["size"] or 0), tot["weight"] or 1.0
    run = range_prefix_sum(ranked, ["ratio", F.col("source").asc_nulls_last()],
                           {"caps": "cap", "ws": "weight"}, "mix-filled")
    full = (F.lit(total) - F.col("caps")) / (F.lit(all_weight) - F.col("ws")) >= F.col("ratio")
    run = materialize(run.withColumn("full", full), "mix-full")
    sat = run.filter("full").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight")).first()
    left = all_weight - (sat["weight"] or 0.0)
    level = (total - (sat["cap"] or 0.0)) / left if left > 0 else 0.0
    return run.select("source", "source_size", "source_start", "class",
                      F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def _segments(schedule) -> Column:
    """The schedule's segments with the area before each, scaled to a whole area of 1."""
    parts, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        parts.append((t0, w0, t1, w1, area))
        area += (w0 + w1) / 2 * (t1 - t0)
    return F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip(("t0", "w0", "t1", "w1", "before"), p)],
                              F.lit(float(area)).alias("area")) for p in parts])


def demand_inverse(share: Column, cls: Column, schedules=SCHEDULES) -> Column:
    """The time at which the scaled integral of the class's schedule reaches ``share`` (0..1)."""
    segs = F.lit(None)
    for k, s in enumerate(schedules):
        segs = F.when(cls == k, _segments(s)).otherwise(segs) if k else F.when(cls == k, _segments(s))
    # the last segment that starts at or before the wanted area
    seg = F.element_at(F.filter(segs, lambda s: (s["before"] <= share * s["area"]) | (s["before"] == 0)), -1)
    area = F.greatest(share * seg["area"] - seg["before"], F.lit(0.0))
    slope = (seg["w1"] - seg["w0"]) / (seg["t1"] - seg["t0"])
    root = F.sqrt(F.greatest(seg["w0"] * seg["w0"] + 2 * slope * area, F.lit(0.0)))
    return F.when(area <= 0, seg["t0"]).otherwise(seg["t0"] + 2 * area / (seg["w0"] + root))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, max_epochs: int = 2, weights: Sequence[int] = WEIGHTS,
        schedules=SCHEDULES, seed: int = SEED) -> DataFrame:
    """One row per input row, range-sorted by position:
    ``id, key, size, source_size, target, taken, position``.

    ``key`` is the seeded hash of id and text; ``position`` (0..1, null if nothing is taken)
    is the training time of the document's first taken word.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.md5(F.concat(ident, F.lit(f":{seed}:"), F.md5(text))).alias("key"))
    ranged = materialize(range_prefix_sum(rows, [F.col("source").asc_nulls_last(), "key"],
                                          {"start": "size"}, "mix-docs"), "mix-offsets")
    targets = source_targets(ranged.groupBy("source").agg(F.sum("size").alias("source_size")),
                             share, max_epochs, weights).withColumnRenamed("source", "s")
    out = ranged.join(targets, ranged["source"].eqNullSafe(targets["s"])).drop("s")
    want = F.round("target").cast("long")
    offset = F.col("start") - F.col("source_start")
    taken = F.lit(0)
    for epoch in range(max_epochs):
        rest = want - offset - F.col("source_size") * epoch
        taken = taken + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    out = out.withColumns({"offset": offset, "taken": taken})
    position = F.when(F.col("taken") > 0, demand_inverse(F.col("offset") / F.col("target"), F.col("class"), schedules))
    out = out.withColumn("position", position)
    out = out.select("id", "source", "key", "size", "source_size", "class", "offset", "target", "taken", "position")
    order = [F.col("position").asc_nulls_last(), "key"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **args) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, sorted by training position.

    A document taken twice appears twice; a cut copy holds its first words and what stands
    before and between them.  ``n_chars``, if present, follows the text.
    """
    schedules, seed = args.get("schedules", SCHEDULES), args.get("seed", SEED)
    # rows that repeat an id and a text share the key; they are numbered on both sides
    plan = mix(docs, id_col, text_col, source_col, **args).withColumn(
        "__nth", F.row_number().over(Window.partitionBy("key").orderBy("offset")))
    epochs = F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int"))
    plan = plan.filter("taken > 0").withColumn("__epoch", F.explode(epochs))
    words = F.least(F.col("taken") - F.col("__epoch") * F.col("size"), F.col("size"))
    share = (F.col("offset") + F.col("__epoch") * F.col("source_size")) / F.col("target")
    plan = plan.select(F.col("key").alias("__key"), "__nth", "__epoch", F.col("size").alias("__size"),
                       words.cast("int").alias("__words"),
                       demand_inverse(share, F.col("class"), schedules).alias("__at"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    keyed = docs.withColumn("__key", F.md5(F.concat(ident, F.lit(f":{seed}:"), F.md5(text))))
    keyed = keyed.withColumn("__nth", F.row_number().over(Window.partitionBy("__key").orderBy("__key")))
    out = keyed.join(plan, ["__key", "__nth"])
    pieces = F.split(F.col(text_col), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("__words")), "")
    out = out.withColumn(text_col, F.when(F.col("__words") < F.col("__size"), cut).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    order = ["__at", "__key", "__epoch"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "position")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':17:' || md5(coalesce(text, ''))) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0::DOUBLE, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS w,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) AS cls, 2.0::DOUBLE * source_size AS cap FROM s),
a AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS t, sum(w) AS ws FROM r),
q AS (SELECT r.*, (a.t - coalesce(sum(cap) OVER o, 0)) / (a.ws - coalesce(sum(w) OVER o, 0)) >= cap / w AS is_full
      FROM r, a WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (max(a.t) - coalesce(sum(cap) FILTER (is_full), 0)) /
             nullif(max(a.ws) - coalesce(sum(w) FILTER (is_full), 0), 0) AS level FROM q, a),
g AS (SELECT source, source_size, cls, CASE WHEN is_full THEN cap ELSE w * level END AS target FROM q, l),
x AS (SELECT d.*, g.source_size, g.target, g.cls,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          ::BIGINT AS off
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
y AS (SELECT *, (least(greatest(round(target)::BIGINT - off, 0), size)
               + least(greatest(round(target)::BIGINT - off - source_size, 0), size))::BIGINT AS taken,
             off / target AS z, CASE cls WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1.5 ELSE 0.5 END AS w0,
             CASE cls WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN -1.0 ELSE 1.0 END AS slope FROM x)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken = 0 THEN NULL WHEN z = 0 THEN 0.0 ELSE 2 * z / (w0 + sqrt(w0 * w0 + 2 * slope * z)) END AS position
FROM y
"""
