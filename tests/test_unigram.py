"""Unigram-LM training: E-step against brute-force enumeration."""

import math
from collections import Counter

from pyspark.sql import functions as F

from corpusmill.operators import unigram


def segmentations(word, pieces, max_len):
    if not word:
        yield []
        return
    for k in range(1, min(max_len, len(word)) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces, max_len):
                yield [word[:k]] + rest


def test_forward_backward_matches_enumeration():
    logp = {"▁": -2.0, "a": -1.5, "b": -1.7, "ab": -2.2, "▁a": -2.5, "ba": -2.9, "▁ab": -3.1}
    word = "▁abab"
    exp, z = unigram._forward_backward(word, logp, 8)
    segs = list(segmentations(word, logp, 8))
    weights = [math.exp(sum(logp[p] for p in s)) for s in segs]
    total = sum(weights)
    assert abs(z - math.log(total)) < 1e-9
    want = Counter()
    for s, w in zip(segs, weights):
        for p in s:
            want[p] += w / total
    assert set(exp) == set(want)
    for p in want:
        assert abs(exp[p] - want[p]) < 1e-9
    assert unigram.viterbi(word, logp) == max(segs, key=lambda s: sum(logp[p] for p in s))


def test_train_unigram_is_normalised(spark):
    text = "low lower lowest newer wider new news banana bandana low low newer"
    wf = spark.createDataFrame(list(Counter(text.split()).items()), "word string, count long")
    pieces = unigram.train_unigram(wf, vocab_size=30, em_iters=2)
    rows = pieces.collect()
    assert abs(sum(math.exp(r.logp) for r in rows) - 1.0) < 1e-9
    table = {r.piece: r.logp for r in rows}
    singles = {p for p in table if len(p) == 1}
    assert len(table) <= max(30, len(singles))
    for w in set(text.split()):
        assert "".join(unigram.viterbi("▁" + w, table)) == "▁" + w


def test_no_word_is_a_row_of_a_shuffle(spark):
    pieces = spark.createDataFrame([("▁", -3.0), ("a", -2.0), ("▁a", -2.5), ("b", -2.2), ("ab", -1.0), ("<s>", -1.0)],
                                   "piece string, logp double")
    vocab = unigram.unigram_vocab(pieces)
    lines = spark.createDataFrame([(0, "aab b"), (1, ""), (2, None), (3, "azb"), (4, "b"), (5, "<s>")], "k long, line string")
    toks = unigram.encode_unigram(lines, pieces, vocab, ["k"])
    plan = toks._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    ids = {r.piece: r.id for r in vocab.collect() if r.id > 3}
    want = {0: [ids["▁a"], ids["ab"], ids["▁"], ids["b"]], 1: [], 2: [], 3: [3], 4: [ids["▁"], ids["b"]],
            5: [ids["▁"], 1, ids["<s>"]]}
    assert {r.k: r.ids for r in toks.collect()} == want
    # rows with one key make one row, place by place
    twice = unigram.encode_unigram(lines.withColumn("k", F.lit(7)).filter("line in ('b', 'aab b')"), pieces, vocab, ["k"]).first().ids
    assert twice == [*sorted([[ids["▁a"], ids["ab"]], [ids["▁"], ids["b"]]])[0], *sorted([[ids["▁a"], ids["ab"]], [ids["▁"], ids["b"]]])[1],
                     ids["▁"], ids["b"]]


def test_a_task_adds_up_the_expected_counts(spark):
    words = spark.createDataFrame([("▁ab", 2.0), ("▁ba", 3.0), ("▁ab", 1.0)] * 20, "w string, c double").coalesce(1)
    pieces = spark.createDataFrame([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0)], "piece string, logp double")
    rows = unigram._e_step(words, pieces, 8).collect()
    assert len(rows) == 4
    one = {}
    for w, c in (("▁ab", 60), ("▁ba", 60)):
        for p, e in unigram._forward_backward(w, {r.piece: r.logp for r in pieces.collect()}, 8)[0].items():
            one[p] = one.get(p, 0) + e * c
    assert all(abs(r.expected - one[r.piece]) < 1e-9 for r in rows)


def test_seeds_are_all_characters_and_the_best_longer_pieces(spark):
    words = spark.createDataFrame([("aba", 3), ("b", 2)], "word string, count long")
    got = {(r.piece, r.freq) for r in unigram.seed_pieces(words, 3, max_piece_len=3).collect()}
    assert got == {("▁", 5), ("a", 6), ("b", 5), ("▁ab", 3), ("aba", 3), ("ab", 3)}
