"""Encode/decode round trip, special ids and tokenizer evaluation."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import tokenize as tok
from corpusmill.operators.vocab import build_vocab, word_table
from corpusmill.sources.sinks import materialize


def test_special_ids_validation():
    assert tok.SpecialIds().resolved().pad == 0
    with pytest.raises(ValueError):
        tok.SpecialIds(pad=2, eos=2).validate()
    tok.SpecialIds(pad=2, eos=2, allow_pad_eq_eos=True).validate()
    assert tok.SpecialIds(pad=-1, bos=-1).resolved(vocab_size=100).bos == 1


@pytest.mark.parametrize("broadcast", [True, False])
def test_encode_decode_roundtrip(spark, broadcast):
    lines = spark.createDataFrame([(0, 0, "b a  b"), (0, 1, ""), (1, 0, " c b ")],
                                  "doc_id long, line_no long, line string")
    v = build_vocab(word_table(lines, "line"))
    ids = {(r.doc_id, r.line_no): r.ids for r in
           tok.encode_words(lines, v, ["doc_id", "line_no"], "line", broadcast_vocab=broadcast).collect()}
    # b: 3 occurrences -> id 4; a, c: 1 each -> 5, 6 (word asc)
    assert ids == {(0, 0): [4, 5, 4], (0, 1): [], (1, 0): [6, 4]}
    toks = spark.createDataFrame([(0, 0, [1, 4, 5, 4, 2]), (1, 0, [6, 4, 3])],
                                 "doc_id long, line_no long, ids array<int>")
    dec = {r.doc_id: r.text for r in
           tok.decode_words(toks, v, ["doc_id", "line_no"], broadcast_vocab=broadcast).collect()}
    assert dec == {0: "b a b", 1: "c b <unk>"}


def test_tokenizer_eval_denominators(spark):
    # one line with one error: the reference formula gives a large negative rate, ours 0.0
    df = spark.createDataFrame([(3, 2, True, False)], "t long, w long, e boolean, b boolean")
    r = tok.tokenizer_eval(df, "t", "w", "e", "b").first()
    assert r.reconstruction_rate == 0.0 and r.reconstruction_rate_ref < -1e8
    # cut-off: blank lines consume an index
    df2 = spark.createDataFrame([(i, 1, 1, i == 1, i == 2) for i in range(6)],
                                "idx long, t long, w long, e boolean, b boolean")
    r2 = tok.tokenizer_eval(df2, "t", "w", "e", "b", index_col="idx", n_lines=4).first()
    assert r2.n_lines == 4 and r2.n_errors == 1
    assert abs(r2.reconstruction_rate_ref - (1 - 1 / 4)) < 1e-6
    assert abs(r2.reconstruction_rate - (1 - 1 / 3)) < 1e-6
    r3 = tok.tokenizer_eval(df2, "t", "w", "e", "b", index_col="idx", n_lines=6).first()
    assert abs(r3.reconstruction_rate_ref - (1 - 1 / 5)) < 1e-6


def test_wrap_and_clamp(spark):
    df = spark.createDataFrame([([5, 9],)], "ids array<int>")
    r = df.select(tok.wrap_special("ids").alias("w"), tok.offset_clamp("ids", 10).alias("c"),
                  tok.byte_pieces(F.lit("é")).alias("b")).first()
    assert r.w == [1, 5, 9, 2] and r.c == [8, 9] and r.b == "<0xC3><0xA9>"


def test_occurrences_are_no_rows_of_a_shuffle(spark):
    # 40 lines of the same 500 words: the words of a group meet the vocabulary once, not once an occurrence
    line = " ".join(f"w{i}" for i in range(500))
    lines = spark.createDataFrame([(i, i % 3, line) for i in range(40)], "doc_id long, line_no long, line string")
    v = materialize(build_vocab(word_table(lines, "line")), "t-vocab")
    ids = materialize(tok.encode_words(lines, v, ["doc_id", "line_no"], broadcast_vocab=False, groups=4), "t-ids")
    assert {tuple(r.ids) for r in ids.collect()} == {tuple(
        {r.piece: r.id for r in v.collect()}[w] for w in line.split())}
    for made in (tok.encode_words(lines, v, ["doc_id", "line_no"], broadcast_vocab=False, groups=4),
                 tok.decode_words(ids, v, ["doc_id", "line_no"], broadcast_vocab=False, groups=4)):
        assert made.count() == 40
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and "posexplode" not in plan and "FlatMapCoGroupsInArrow" in plan
    assert {r.text for r in tok.decode_words(ids, v, ["doc_id", "line_no"], groups=4).collect()} == {line}


@pytest.mark.parametrize("groups", [1, 5])
def test_repeated_and_null_keys_make_one_row(spark, groups):
    lines = spark.createDataFrame([(0, 0, "a b"), (0, 0, "c"), (None, 1, "b x"), (None, 1, None), (2, None, None)],
                                  "doc_id long, line_no long, line string")
    vocab = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6), ("c", 7)], "piece string, id int")
    got = tok.encode_words(lines, vocab, ["doc_id", "line_no"], groups=groups)
    assert got.dtypes == [("doc_id", "bigint"), ("line_no", "bigint"), ("ids", "array<int>")]
    assert {(r.doc_id, r.line_no): r.ids for r in got.collect()} == {(0, 0): [4, 6, 7, 5], (None, 1): [5, 3], (2, None): []}
    back = tok.decode_words(got, vocab, ["doc_id", "line_no"], groups=groups).collect()
    assert {(r.doc_id, r.line_no): r.text for r in back} == {(0, 0): "a c c b", (None, 1): "b", (2, None): ""}
