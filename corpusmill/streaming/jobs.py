"""Structured Streaming versions of the cleaning, redaction and dedup operators.

The transformations are the batch Column expressions applied to a streaming
DataFrame; only the source, the state and the sink differ.  Sinks are file
sinks with a checkpoint location under the shared checkpoint folder, so a
restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..sources.sinks import scratch_path


def request_stream(spark: SparkSession, directory: str, schema: StructType | str,
                   glob: str | None = None, body_col: str = "body", text_col: str = "text",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """One event per request with its body decoded as UTF-8, invalid bytes dropped.

    Files in ``directory`` (matching ``glob``) are parquet with a binary (or
    string) ``body_col``; on a cluster the same shape comes from Kafka's value.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.parquet(directory)
    return df.withColumn(text_col, T.decode_lenient(F.col(body_col).cast("binary")))


def redact_stream(events: DataFrame, text_col: str = "text") -> DataFrame:
    """Stateless: e-mail then phone redaction on every arriving record."""
    return events.withColumn(text_col, T.redact_pii(text_col))


def normalize_stream(records: DataFrame, text_col: str = "text", min_chars: int = T.MIN_CHARS) -> DataFrame:
    """Stateless: corpus normaliser and length filter on arriving records."""
    return records.withColumn(text_col, T.normalize_text(text_col)).filter(F.length(text_col) >= min_chars)


def dedup_stream(records: DataFrame, key_cols, event_time: str | None = None,
                 delay: str | None = None) -> DataFrame:
    """Drop repeated keys.

    Without ``event_time`` the state keeps every key ever seen (exact, unbounded
    state -- the reference's in-memory ``seen`` set).  With ``event_time`` and
    ``delay`` the state is bounded by the watermark: a copy arriving later than
    ``delay`` after the watermark passed its first occurrence is not caught.
    """
    keys = list(key_cols)
    if event_time is None:
        return records.dropDuplicates(keys)
    if delay is None:
        raise ValueError("a watermark delay is required with event_time")
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append",
                      path: str | None = None) -> str:
    """Process everything available and stop; returns the parquet sink path."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, f"stream-{name}")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", path + "/_checkpoint")
         .trigger(availableNow=True).start(path + "/data"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return path + "/data"
