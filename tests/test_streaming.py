"""Streaming results equal the batch results."""

import glob
import hashlib
import os
import shutil

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.plans import catalog
from corpusmill.streaming import jobs


def test_stream_redact_equals_batch(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "requests")
    rows = [(1, bytearray(b"mail me at a.b@ex.com \xff now")), (2, bytearray("call 555 123 4567".encode())),
            (3, bytearray(b"plain"))]
    spark.createDataFrame(rows, "id long, body binary").write.parquet(src)
    events = jobs.request_stream(spark, src, "id long, body binary")
    out = jobs.run_available_now(jobs.redact_stream(events).select("id", "text"), "t-redact",
                                 path=os.path.join(tmpdir_fresh, "sink"))
    got = {r.id: r.text for r in spark.read.parquet(out).collect()}
    batch = spark.read.parquet(src).select("id", T.redact_pii(T.decode_lenient("body")).alias("text"))
    assert got == {r.id: r.text for r in batch.collect()}
    assert got[1] == "mail me at [EMAIL_REDACTED]  now" and got[2] == "call [PHONE_REDACTED]"


def test_stream_dedup_unbounded_and_watermarked(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "lines")
    rows = [(i, f"k{i % 3}", i) for i in range(12)]
    spark.createDataFrame(rows, "id long, k string, t long").write.parquet(src)
    s = spark.readStream.schema("id long, k string, t long").parquet(src)
    out = jobs.run_available_now(jobs.dedup_stream(s, ["k"]).select("k"), "t-dedup",
                                 path=os.path.join(tmpdir_fresh, "sink1"))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["k0", "k1", "k2"]
    s2 = spark.readStream.schema("id long, k string, t long").parquet(src).withColumn(
        "ts", F.timestamp_seconds("t"))
    out2 = jobs.run_available_now(jobs.dedup_stream(s2, ["k"], "ts", "1 hour").select("k"), "t-dedup2",
                                  path=os.path.join(tmpdir_fresh, "sink2"))
    assert sorted(r.k for r in spark.read.parquet(out2).collect()) == ["k0", "k1", "k2"]


def test_stream_normalize_equals_batch(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "docs")
    rows = [(1, "  été\t  long enough text for the filter here "), (2, "short")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(src)
    s = spark.readStream.schema("doc_id long, text string").parquet(src)
    out = jobs.run_available_now(jobs.normalize_stream(s), "t-norm", path=os.path.join(tmpdir_fresh, "sink"))
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [
        (1, "été long enough text for the filter here")]


@pytest.mark.parametrize("folders", [False, True])
def test_stream_queries_read_files_and_folders(spark, tmpdir_fresh, folders):
    # large tables are folders of part files, small ones single files
    tables = {"documents": [(1, "a line that is long enough to be kept\nand another one"),
                            (2, "a line that is long enough to be kept"), (3, "short")],
              "conversations": [(7, 0, "user", "mail me at a.b@ex.com"), (7, 1, "bot", None)]}
    for name, rows in tables.items():
        schema = "doc_id long, text string" if name == "documents" else catalog.CONV_SCHEMA
        parts = os.path.join(tmpdir_fresh, f"{name}.parquet" if folders else name)
        spark.createDataFrame(rows, schema).repartition(2 if folders else 1).write.parquet(parts)
        if not folders:
            part, = glob.glob(os.path.join(parts, "*.parquet"))
            shutil.copy(part, os.path.join(tmpdir_fresh, f"{name}.parquet"))
    got = catalog.QUERIES["stream_redact"](spark, tmpdir_fresh).collect()
    assert sorted(map(tuple, got)) == [(7, 0, "mail me at [EMAIL_REDACTED]"), (7, 1, None)]
    got = catalog.QUERIES["stream_normalize"](spark, tmpdir_fresh).collect()
    assert sorted(map(tuple, got)) == [(i, text) for i, text in tables["documents"] if i != 3]
    got = catalog.QUERIES["stream_dedup_lines"](spark, tmpdir_fresh).collect()
    lines = {line for i, text in tables["documents"] if i != 3 for line in text.split("\n")}
    assert sorted(r.content_hash for r in got) == sorted(hashlib.sha256(x.encode()).hexdigest() for x in lines)
