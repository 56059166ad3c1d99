"""Packing, chunking and padding."""

import random

from pyspark.sql import functions as F

from corpusmill.operators import sequences as Q


def tokens_df(spark, seqs):
    rows = [(i, 0, s) for i, s in enumerate(seqs)]
    return spark.createDataFrame(rows, "doc_id long, line_no long, ids array<int>")


def brute_pack(seqs, L, eos=2):
    stream = [t for s in seqs for t in s + [eos]]
    return [stream[i:i + L] for i in range(0, len(stream) - L + 1, L)]


def test_pack_hand_example(spark):
    # lengths 3, 0, 2 with EOS and seq_len 4: 8 ids -> 2 sequences; the blank record gives one EOS
    df = tokens_df(spark, [[10, 11, 12], [], [13, 14]])
    got = [r.input_ids for r in Q.pack(df, seq_len=4).orderBy("seq_id").collect()]
    assert got == [[10, 11, 12, 2], [2, 13, 14, 2]]


def test_pack_matches_brute_force_any_partitioning(spark):
    rnd = random.Random(7)
    seqs = [[rnd.randrange(4, 50) for _ in range(rnd.choice([0, 1, 3, 17, 40, 130]))] for _ in range(300)]
    want = brute_pack(seqs, 16)
    for parts in (1, 7, 64):
        df = tokens_df(spark, seqs).repartition(parts)
        got = Q.pack(df, seq_len=16, line_width=2, doc_group=13).orderBy("seq_id").collect()
        assert [r.input_ids for r in got] == want
        assert all(r.attention_mask == [1] * 16 for r in got)
    total = sum(len(s) + 1 for s in seqs)
    assert 16 * len(want) + total % 16 == total  # conservation


def test_chunk_hand_examples(spark):
    df = tokens_df(spark, [list(range(41)), list(range(20))])
    rows = Q.chunk_lines(df, 20).orderBy("doc_id", "chunk_no").collect()
    assert [(r.doc_id, r.ids[0], len(r.ids)) for r in rows] == [(0, 0, 21), (0, 20, 21)]


def test_truncate_shift_pad(spark):
    df = spark.createDataFrame([([1, 5, 6, 7, 2],)], "ids array<int>")
    r = df.select(Q.truncate("ids", 3).alias("t"), Q.truncate_left("ids", 3).alias("l"),
                  Q.shift_x("ids").alias("x"), Q.shift_y("ids").alias("y"),
                  Q.pad_to("ids", 8).alias("p"), Q.attention_mask(Q.pad_to("ids", 7)).alias("m")).first()
    assert r.t == [1, 5, 6] and r.l == [6, 7, 2]
    assert r.x == [1, 5, 6, 7] and r.y == [5, 6, 7, 2]
    assert r.p == [1, 5, 6, 7, 2, 0, 0, 0] and r.m == [1, 1, 1, 1, 1, 0, 0]


def test_pad_dynamic_per_batch(spark):
    df = spark.createDataFrame([(0, [1, 2], [2, 3]), (0, [1, 2, 3, 4], [2, 3, 4, 5]), (1, [9], [8])],
                               "batch_id long, x array<int>, y array<int>")
    rows = {tuple(r.x): r for r in Q.pad_dynamic(df).collect()}
    assert rows[(1, 2, 0, 0)].y == [2, 3, 0, 0]
    assert rows[(1, 2, 0, 0)].attention_mask == [1, 1, 0, 0]
    assert rows[(9,)].x == [9]


def test_seq_length_filter(spark):
    df = spark.createDataFrame([([1],), ([1, 2],), ([1, 2, 3],)], "ids array<int>")
    assert Q.seq_length_filter(df, "ids", 2).count() == 1
    assert Q.seq_length_filter(df, "ids").count() == 2


def test_pack_hot_document(spark):
    # one document with many lines next to small ones: split by line range, same result
    seqs = [[7] * (i % 5) for i in range(500)]
    rows = [(0, i, s) for i, s in enumerate(seqs)] + [(1, 0, [9, 9, 9])]
    df = spark.createDataFrame(rows, "doc_id long, line_no long, ids array<int>")
    got = [r.input_ids for r in Q.pack(df, seq_len=8, line_width=16, doc_group=1).orderBy("seq_id").collect()]
    assert got == brute_pack(seqs + [[9, 9, 9]], 8)
