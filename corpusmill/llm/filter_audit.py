"""Interaction of document filters by the Hart-Mas-Colell potential of the removal game (DataFrame operations only).

Five filters judge each whole document (:data:`FILTERS`).  In the removal game of a part of the
corpus, a coalition ``S`` of filters is worth ``v(S)``, the documents that at least one of them
rejects.  A document is a five-bit mask of the filters it fails, so one aggregate to at most 32
rows a part holds all that is needed:

1. ``v(S)`` = documents whose mask meets ``S``, for all 32 coalitions; likewise the good
   and the toxic documents removed.
2. The potential is built from small coalitions to large ones:
   ``P(S) = (v(S) + sum of P(S - i) over i in S) / |S|``.  Kept as ``|S|! P(S)`` it stays an integer.
3. The Shapley value of filter ``i`` is ``P(N) - P(N - i)``.
4. A step that applies ``i`` after the filters of ``S`` removes ``v(S + i) - v(S)``; all other
   figures of the 120 orders are such differences too.

Filter E asks for the smallest id of each text.  It is found by an aggregate over digests, and joined
back on id and digest together, so copies of one text, however many, are never in one task.

Nulls and edge cases: a null text counts as empty and fails A (and E, if another empty text has a
smaller id); a null source is the part ``''``; a row with a null id never fails E, makes no other row fail it, and
has no label; rows that repeat an id and a text do not make each other fail E, and each is counted;
labels that repeat an id are good or toxic if one of them says so, null labels say nothing; an empty
table gives no rows.  Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialize

SPACE = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def _text_filters(text: Column) -> list[Column]:
    """Failure conditions A to D of a text that is not null."""
    inner = F.btrim(text, F.lit(SPACE))
    words = F.split(inner, WORD_BREAK)
    n_words, n_distinct = (F.when(inner == "", 0).otherwise(F.size(w)) for w in (words, F.array_distinct(words)))
    return [n_words < 50,
            100 * n_distinct < 65 * n_words,
            100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.char_length(text),
            text.rlike("[#$%&*|]")]


#: letters of the filters: few words, few distinct words, capitals, signs, copy of an earlier text
FILTERS = "ABCDE"
COPY_BIT = 1 << FILTERS.index("E")


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """One row per document: ``part, mask, good, toxic`` (the last two 0 or 1)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    mask = sum((F.when(bad, F.lit(1 << i)).otherwise(F.lit(0)) for i, bad in enumerate(_text_filters(F.col("text")))), F.lit(0))
    rows = (docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(part_col, F.lit("")).alias("part"))
            .select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.cast("int").alias("mask")))
    rows = materialize(rows, "filter-masks")  # texts are read once
    first = (rows.filter(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id"))
             .withColumn("first", F.lit(True)))
    # rows without an id match nothing; a number from the digest spreads them over the tasks of the second join
    rows = rows.join(first, ["id", "digest"], "left").select(
        "id", "part", F.when(F.col("id").isNotNull() & F.col("first").isNull(), F.col("mask") + COPY_BIT)
        .otherwise(F.col("mask")).alias("mask"),
        F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)).alias("spread"))
    marks = (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(out)
                    for c, out in (("quality", "good"), ("toxic", "toxic"))])
             .filter("good + toxic > 0").withColumn("spread", F.lit(0).cast("long")))
    out = rows.withColumn("spread", F.col("spread").cast("long")).join(marks, ["id", "spread"], "left")
    return out.select("part", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def _games(failed: DataFrame) -> DataFrame:
    """One row per part: ``n`` documents, and ``v_all, v_good, v_toxic``, each an array with the
    documents that each coalition removes (coalition ``S`` at index ``S``)."""
    cells = failed.groupBy("part", "mask").agg(F.count("*").alias("all"), F.sum("good").alias("good"),
                                               F.sum("toxic").alias("toxic"))
    return cells.groupBy("part").agg(F.sum("all").alias("n"), *[F.expr(_array(
        f"sum(if((mask & {s}) != 0, `{c}`, 0))" for s in range(1 << len(FILTERS)))).alias(f"v_{c}") for c in ("all", "good", "toxic")])


def _array(items) -> str:
    return "array(" + ", ".join(items) + ")"


def _potential(games: DataFrame) -> DataFrame:
    """Add ``pot``: ``|S|!`` times the potential of each coalition of the game ``v_all``."""
    size = 1 << len(FILTERS)
    games = games.withColumn("pot0", F.expr(_array(["0L"] * size)))
    for k in range(1, len(FILTERS) + 1):  # coalitions of k filters from those of k - 1
        before, now = f"pot{k - 1}", []
        for s in range(size):
            below = " + ".join(f"{before}[{s ^ (1 << i)}]" for i in range(len(FILTERS)) if s >> i & 1)
            now.append(f"{math.factorial(k - 1)}L * v_all[{s}] + {below}" if s.bit_count() == k else f"{before}[{s}]")
        games = games.withColumn(f"pot{k}", F.expr(_array(now))).drop(before)
    return games.withColumnRenamed(f"pot{len(FILTERS)}", "pot")


def coalitions(failed: DataFrame) -> DataFrame:
    """``part, coalition, removed, good_lost, toxic_lost, potential``: 32 rows a part.

    ``coalition`` is the letters of its filters; ``potential`` is a double.
    """
    names = _array("named_struct('s', {}, 'coalition', '{}', 'scale', {})".format(
        s, "".join(c for i, c in enumerate(FILTERS) if s >> i & 1), math.factorial(s.bit_count())) for s in range(1 << len(FILTERS)))
    rows = _potential(_games(failed)).select("*", F.inline(F.expr(names)))
    return rows.select("part", "coalition", F.get("v_all", F.col("s")).alias("removed"), F.get("v_good", F.col("s")).alias("good_lost"),
                       F.get("v_toxic", F.col("s")).alias("toxic_lost"), (F.get("pot", F.col("s")) / F.col("scale")).alias("potential"))


def shapley(failed: DataFrame) -> DataFrame:
    """``part, filter, shapley`` (double): documents removed by each filter, averaged over all orders."""
    whole = coalitions(failed).groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("coalition", "potential"))).alias("p"))
    names = F.array(*[F.struct(F.lit(c).alias("filter"), F.lit(FILTERS.replace(c, "")).alias("rest")) for c in FILTERS])
    return whole.select("part", "p", F.inline(names)).select("part", "filter", (F.col("p")[F.lit(FILTERS)] - F.col("p")[F.col("rest")]).alias("shapley"))


def audit(failed: DataFrame) -> DataFrame:
    """Every step of every order: ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley`` (the last summed over all orders)."""
    k, full = len(FILTERS), (1 << len(FILTERS)) - 1
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, c in enumerate(order, 1):
            i = FILTERS.index(c)
            steps.append("named_struct('filter_order', '{}', 'step', {}, 'one', {}, 's', {})".format(
                "".join(order), step, 1 << i, before))
            before |= 1 << i
    rows = _potential(_games(failed)).select("*", F.inline(F.expr(_array(steps))))
    one, s = F.col("one"), F.col("s")
    after, rest = s.bitwiseOR(one), F.lit(full).bitwiseXOR(one)

    def gain(game: str) -> Column:
        return F.get(game, after) - F.get(game, s)
    return rows.select(
        "part", "filter_order", "step", (F.col("n") - F.get("v_all", after)).alias("kept"),
        gain("v_all").alias("removed"), (F.get("v_all", one) - gain("v_all")).alias("redundant"),
        (F.get("v_all", F.lit(full)) - F.get("v_all", rest)).alias("unique_fails"),
        gain("v_good").alias("good_lost"), gain("v_toxic").alias("toxic_lost"),
        # k! P(N) - k! P(N - i), where pot holds (k - 1)! P(N - i)
        (F.get("pot", F.lit(full)) - k * F.get("pot", rest)).alias("shapley"))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return audit(failures(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


_STEP = """SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders)"""

OP11_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
             min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels
        WHERE doc_id IS NOT NULL GROUP BY 1),
f AS (SELECT w.part,
             CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN w.doc_id > first_id THEN 'E' ELSE '' END AS fails,
             coalesce(good, 0) AS good, coalesce(lab.toxic, 0) AS toxic
      FROM w LEFT JOIN lab ON lab.doc_id = w.doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM l a, l b, l d, l e, l g
           WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
steps AS ({_STEP}),
x AS (SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS hit, fails = letter AS alone,
             fails <> '' AND translate(fails, earlier, '') <> fails AS gone
      FROM cells, steps),
r AS (SELECT part, filter_order, step, letter,
             sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
      FROM x GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
