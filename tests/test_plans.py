"""Plan checks: no cross joins and no row-at-a-time Python UDFs in any query plan."""

import pytest

import __spark_entry__ as E
from corpusmill.operators import dedup, metrics, ngram
from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]
CHEAP = ["normalize_text", "dedup_lines", "dedup_stats", "build_vocab", "encode_words", "decode_words",
         "pack_sequences", "train_val_split", "epoch_shuffle", "pad_dynamic", "tokenizer_eval",
         "dpo_project", "conversation_messages", "doc_nll", "running_best", "retain_latest",
         "topk_ties", "nucleus_filter", "sample_next", "near_dup_clusters", "sentence_sample",
         "char_coverage", "stream_dedup_lines", "scan_jsonl_or_text"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_plan_has_no_forbidden_operator(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in text, f"{name} plans {op}"


def test_exact_dedup_keeps_text_out_of_the_aggregate(spark):
    df = spark.createDataFrame([(2, 0, " a"), (1, 3, "a"), (1, 1, "b"), (1, 4, "b"), (-1, 7, "c"), (-1, -2, "c")],
                               "doc_id long, line_no int, line string")
    out = dedup.dedup_first(df, ["doc_id", "line_no"], "line")
    assert sorted(map(tuple, out.collect())) == [(-1, -2, "c"), (1, 1, "b"), (1, 3, "a")]
    assert "SortAggregate" not in plan_text(out)


def test_top_k_is_limited_before_its_only_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS run", "id AS step")
    text = plan_text(metrics.retain_latest(df))
    assert text.count("Exchange") == 1 and "WindowGroupLimit" in text


def test_generation_plan_does_not_grow_with_steps(spark):
    probs = spark.createDataFrame([(5, 5, 0.6, 0.0), (5, 6, 0.4, 0.6), (6, 5, 1.0, 0.0)],
                                  "prompt_id long, token_id long, prob double, mass_before double")
    prompts = spark.createDataFrame([(i, [1, 5]) for i in range(20)], "seq_id long, ids array<int>")
    out = ngram.generate(prompts, probs, max_len=6, seed=3)
    assert "Join" not in plan_text(out) and "Exchange" not in plan_text(out)
    assert {(r.seq_id, r.n_generated, len(r.ids)) for r in out.collect()} == {(i, 6, 8) for i in range(20)}
