"""Corpus and record scans.

``read_corpus`` reads JSONL-or-text files line by line: a line that is a JSON
object contributes its ``text`` field ("" when absent), any line that does not
parse as JSON is the text itself, and records the reference would crash on
(non-object JSON, null or non-string text) are quarantined with a reason
instead of aborting the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.udfs import json_record, json_strict_ok

RECORD_SCHEMA = "text string, _corrupt string"


def _json_kind(line: Column) -> Column:
    """Type of the JSON value in ``line`` (``object``, ``array``, ...) or null when
    Python's decoder would reject the line.  ``NaN``/``Infinity`` are numbers, as
    Python accepts them.

    Spark's parser stops after the first value and ignores what follows, so a
    parsed line is rechecked by Python's decoder only when it looks suspicious:
    it does not end with the closing character of its kind, a closing bracket is
    directly followed by another value, or a scalar contains whitespace.
    Ordinary JSONL records never leave the JVM; objects and arrays that Spark's
    parser refuses are read by ``json_record`` instead.
    """
    v = F.try_parse_json(line)
    kind = F.schema_of_variant(v)
    special = line.isin("NaN", "Infinity", "-Infinity")
    is_obj, is_arr = kind.startswith("OBJECT"), kind.startswith("ARRAY")
    ends_ok = (F.when(is_obj, line.endswith("}")).when(is_arr, line.endswith("]"))
               .when(kind == "STRING", line.endswith('"'))
               .otherwise(~line.rlike(r"\s")))
    adjacent = line.rlike(r"[}\]]\s*[^\s,}\]]")
    suspicious = v.isNotNull() & (~ends_ok | adjacent)
    valid = F.when(suspicious, json_strict_ok(F.when(suspicious, line))).otherwise(v.isNotNull())
    return (F.when(special, F.lit("number"))
            .when(~valid, F.lit(None))
            .when(is_obj, F.lit("object"))
            .when(is_arr, F.lit("array"))
            .when(kind == "VOID", F.lit("null"))
            .otherwise(F.lower(kind)))


def parse_corpus_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Classify raw lines: adds ``text`` and ``reject_reason`` (null for good rows).

    Blank lines (after Python ``strip``) are removed first.
    """
    stripped = T.py_strip(line_col)
    d = lines.withColumn("__line", stripped).filter(F.col("__line") != "")
    refused = F.try_parse_json("__line").isNull() & F.col("__line").rlike(r"^[{\[]")
    d = d.withColumn("__py", json_record(F.when(refused, F.col("__line"))))
    kind = F.coalesce("__py.kind", _json_kind(F.col("__line")))
    d = d.withColumn("__kind", kind)
    v = F.try_parse_json(F.col("__line"))
    text_var = F.try_variant_get(v, "$.text", "string")
    text_type = F.coalesce("__py.text_type", F.schema_of_variant(F.variant_get(v, "$.text", "variant")))
    has_text = F.expr("__py.text_type is not null or try_variant_get(try_parse_json(__line), '$.text', 'variant') is not null")
    is_obj = F.col("__kind") == "object"
    text = (F.when(F.col("__kind").isNull(), F.col("__line"))
            .when(is_obj & ~has_text, F.lit("")).when(is_obj & (text_type == "STRING"), F.coalesce("__py.text", text_var)))
    reason = (F.when(F.col("__kind").isNull(), F.lit(None))
              .when(~is_obj, F.concat(F.lit("json value is not an object: "), F.col("__kind")))
              .when(~has_text, F.lit(None))
              .when(text_type == "VOID", F.lit("text is null"))
              .when(text_type != "STRING", F.concat(F.lit("text is not a string: "), F.lower(text_type))))
    return d.withColumn("text", text).withColumn("reject_reason", reason).drop("__line", "__kind", "__py")


def read_corpus(spark: SparkSession, paths: Sequence[str] | str, with_rejects: bool = False,
                min_chars: int = T.MIN_CHARS):
    """Ingest JSONL-or-text files (S1, S2, S4), normalise and length-filter them.

    Output ``(path_rank, path, block_start, line_no, text)``, whose columns in
    that order are the input order: the rank of the path in the argument list,
    the start of the file split, then the position inside the split.  With ``with_rejects`` also returns the quarantine.
    """
    if isinstance(paths, str):
        paths = [paths]
    raw = []
    for rank, p in enumerate(paths):
        df = (spark.read.text(p).select("value", F.col("_metadata.file_path").alias("path"),
                                        F.col("_metadata.file_block_start").alias("__blk"))
              .withColumn("path_rank", F.lit(rank)))
        raw.append(df)
    lines = raw[0]
    for other in raw[1:]:
        lines = lines.unionByName(other)
    # position inside a file split; (path_rank, path, block_start, line_no) is the input order
    lines = lines.withColumn("line_no", F.monotonically_increasing_id()).withColumnRenamed(
        "__blk", "block_start")
    parsed = parse_corpus_lines(lines)
    good = parsed.filter(F.col("reject_reason").isNull())
    good = good.withColumn("text", T.normalize_text("text")).filter(
        F.length("text") >= min_chars).select("path_rank", "path", "block_start", "line_no", "text")
    if not with_rejects:
        return good
    rejects = parsed.filter(F.col("reject_reason").isNotNull()).select(
        "path_rank", "path", "block_start", "line_no", F.col("value").alias("line"), "reject_reason")
    return good, rejects


SFT_SCHEMA = "prompt string, response string, _corrupt string"
DPO_SCHEMA = "prompt string, chosen string, rejected string, _corrupt string"


def _read_json_records(spark: SparkSession, paths, schema: str, fields: list[str]):
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt").json(paths))
    ok = F.col("_corrupt").isNull()
    for f in fields:
        ok = ok & F.col(f).isNotNull()
    good = df.filter(ok).select(*fields)
    bad = df.filter(~ok).withColumn(
        "reject_reason", F.when(F.col("_corrupt").isNotNull(), F.lit("malformed json"))
        .otherwise(F.lit("missing field")))
    return good, bad


def read_sft(spark: SparkSession, paths, with_rejects: bool = False):
    """``{prompt, response}`` JSONL with an explicit schema."""
    good, bad = _read_json_records(spark, paths, SFT_SCHEMA, ["prompt", "response"])
    return (good, bad) if with_rejects else good


def read_preferences(spark: SparkSession, paths, with_rejects: bool = False):
    """``{prompt, chosen, rejected}`` JSONL with an explicit schema."""
    good, bad = _read_json_records(spark, paths, DPO_SCHEMA, ["prompt", "chosen", "rejected"])
    return (good, bad) if with_rejects else good
