"""Scans, quarantine and sinks."""

import json
import os

from pyspark.sql import functions as F

from corpusmill.sources import corpus, packed, sinks


def write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


LONG = "x" * 40


def test_read_corpus_corner_cases(spark, tmpdir_fresh):
    p1 = os.path.join(tmpdir_fresh, "a.jsonl")
    p2 = os.path.join(tmpdir_fresh, "b.txt")
    write(p1, [json.dumps({"text": "first " + LONG}), '{"a":1}', "", "   ",
               '{"text":null}', '{"text":5}', "[1]", '"x"', "123", "NaN",
               '{"text":"a"} trailing ' + LONG, "plain " + LONG, "{bad " + LONG, "short"])
    p2_lines = ["second\tfile " + LONG]
    write(p2, p2_lines)
    good, bad = corpus.read_corpus(spark, [p1, p2], with_rejects=True)
    rows = good.orderBy("path_rank", "path", "block_start", "line_no").collect()
    texts = [r.text for r in rows]
    assert texts == ["first " + LONG, '{"text":"a"} trailing ' + LONG, "plain " + LONG,
                     "{bad " + LONG, "second file " + LONG]
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert len(reasons) == 6
    assert "text is null" in reasons
    assert any(r.startswith("text is not a string") for r in reasons)


def test_records_that_only_python_reads(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "a.jsonl")
    write(p, ['{"text":"nan %s","x":NaN}' % LONG, '{"text":"inf %s","x":-Infinity}' % LONG,
              '{"text":"old","text":"new %s"}' % LONG, '{"x":NaN}', '{"text":null,"x":NaN}', '{"text":NaN}', "[NaN]",
              "[not json " + LONG])
    good, bad = corpus.read_corpus(spark, p, with_rejects=True)
    assert sorted(r.text for r in good.collect()) == ["[not json " + LONG, "inf " + LONG, "nan " + LONG, "new " + LONG]
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "json value is not an object: array", "text is not a string: float", "text is null"]


def test_sft_and_preference_scans(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "sft.jsonl")
    write(p, [json.dumps({"prompt": "p1", "response": "r1"}), json.dumps({"prompt": "p2"}), "{oops"])
    good, bad = corpus.read_sft(spark, p, with_rejects=True)
    assert [tuple(r) for r in good.collect()] == [("p1", "r1")]
    assert bad.count() == 2
    q = os.path.join(tmpdir_fresh, "dpo.jsonl")
    write(q, [json.dumps({"prompt": "p", "chosen": "c", "rejected": "r"})])
    assert [tuple(r) for r in corpus.read_preferences(spark, q).collect()] == [("p", "c", "r")]


def test_packed_roundtrip_and_count(spark, tmpdir_fresh):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 1, 1, 1]), ([5, 6, 7, 8], [1, 1, 1, 1])],
                               "input_ids array<int>, attention_mask array<tinyint>")
    path = os.path.join(tmpdir_fresh, "packed")
    assert sinks.write_packed(df, path) == 2
    back = packed.read_packed(spark, path)
    assert dict(back.dtypes)["input_ids"] == "array<int>"
    assert dict(back.dtypes)["attention_mask"] == "array<tinyint>"
    assert sorted(r.labels for r in back.collect()) == [[1, 2, 3, 4], [5, 6, 7, 8]]


def test_text_sink_keeps_order(spark, tmpdir_fresh):
    df = spark.range(0, 50).select(F.col("id"), F.concat(F.lit("line "), F.col("id")).alias("text"))
    path = os.path.join(tmpdir_fresh, "txt")
    sinks.write_text(df.repartition(7), path, "text", order_cols=["id"])
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    got = []
    for f in files:
        with open(os.path.join(path, f), encoding="utf-8") as fh:
            got += fh.read().splitlines()
    assert got == [f"line {i}" for i in range(50)]


def test_vocab_roundtrip(spark, tmpdir_fresh):
    v = spark.createDataFrame([("<pad>", 0, None), ("the", 4, 10)], "piece string, id int, count long")
    path = os.path.join(tmpdir_fresh, "vocab")
    sinks.write_vocab(v, path)
    assert sorted(tuple(r) for r in sinks.read_vocab(spark, path).collect()) == [("<pad>", 0, None),
                                                                                  ("the", 4, 10)]


def test_shard_sink_partition_pruning(spark, tmpdir_fresh):
    df = spark.range(0, 40).select(F.col("id"), (F.col("id") % 4).cast("int").alias("rank"))
    path = os.path.join(tmpdir_fresh, "shards")
    sinks.write_shards(df, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("rank=")) == [f"rank={r}" for r in range(4)]
    one = spark.read.parquet(path).filter("rank = 2")
    assert sorted(r.id for r in one.collect()) == list(range(2, 40, 4))


def test_spread_only_coarse_scans(spark):
    from corpusmill.sources.scan import spread
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = spread(docs, "doc_id")
    assert 1 <= out.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert out.count() == docs.count()
    many = spark.range(0, 1000, numPartitions=64)
    assert spread(many, "id") is many
