"""Turn pairs and stream dedup on inputs the synthetic tables do not have."""

import os

from corpusmill.operators import instruct
from corpusmill.streaming import jobs


def test_pairs_with_gaps_and_repeated_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 2, "assistant", "b"), (1, 7, "user", "c"), (1, 8, "user", "d"), (1, 9, "assistant", "e"),
            (2, 3, "assistant", "f"), (2, 5, "user", "g"), (3, 0, "assistant", "h"), (3, 1, "user", "i"),
            (3, 1, "assistant", "j"), (3, 2, "assistant", "k"), (4, 0, "user", None), (4, 1, "assistant", "l")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {tuple(r) for r in instruct.conversation_pairs(df).collect()}
    assert got == {(1, 0, "a", "b"), (1, 8, "d", "e"), (3, 1, "i", "k"), (4, 0, None, "l")}
    assert instruct.conversation_pairs(df.limit(0)).count() == 0


def test_exact_stream_dedup_over_several_batches(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    for k in range(3):
        spark.range(0, 40).selectExpr(f"concat('p', (id + {10 * k}) % 45) AS props").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("props string").option("maxFilesPerTrigger", 1).parquet(src)
    out = jobs.run_available_now(jobs.dedup_stream(stream, ["props"]), "several")
    got = [r.props for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) == 45
