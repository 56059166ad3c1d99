"""Crowded regions of the Jaccard join: they get smaller by round, and no link is lost."""

import random

import numpy as np
import pytest

from corpusmill.llm import jaccard_join
from test_text_ops import components, frame


def traced(spark, texts, leaf):
    trace = []
    docs = frame(spark, texts).select("doc_id", "text")
    got = jaccard_join._components(docs, "doc_id", "text", leaf=leaf, trace=trace).collect()
    rows = sorted((str(r["id"]), r["n_shingles"], str(r["component_id"])) for r in got)
    assert rows == components(texts, list(range(len(texts))))
    return trace


def test_unlike_documents_that_share_a_passage(spark):
    """All regions are crowded by the passage; the pivot's residual windows part them."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"u{k}_{i}" for i in range(12)) for k in range(120)]
    trace = traced(spark, texts, 8)
    rows = [t[0] for t in trace]
    assert all(b <= a for a, b in zip(rows, rows[1:]))
    assert sum(t[1] + t[2] for t in trace) < 120 * 119 / 2 / 10


@pytest.mark.parametrize("seed", [0])
def test_documents_made_of_a_pool_of_passages(spark, seed):
    """Pivots below pivots, sizes far apart, inner nodes of several pivots, chains of links."""
    rng = random.Random(seed)
    pool = [" ".join(f"q{k}_{i}" for i in range(rng.choice([8, 20, 30]))) for k in range(9)]
    texts = []
    for _ in range(44):
        parts = rng.sample(pool, rng.randint(1, 6)) if rng.random() < 0.5 else pool[:rng.randint(2, 8)]
        words = " ".join(parts).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9)}"
        texts.append(" ".join(words + [f"y{rng.randint(0, 99)}" for _ in range(rng.choice([0, 0, 2, 9]))]))
    trace = traced(spark, texts, 16)
    assert len(trace) > 1


def test_a_long_chain_is_one_component(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 999), (999, 998), (5, 5)]
    got = {r["node"]: r["label"] for r in jaccard_join.components_of(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(got) == 304 and len({got[i] for i in range(301)}) == 1 and {got[i] for i in (998, 999, 1000)} == {998}


def test_words_built_to_agree_modulo_a_power_of_two():
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    x, y = jaccard_join.shingle_sets([a.encode(), b.encode()])
    assert len(x) == len(y) == 1 and x[0] != y[0]


def test_a_long_shared_passage_crowds_no_region(spark):
    """Its shingles come last wherever they stand in a set, so documents with enough words of their own never meet."""
    passage = " ".join(f"p{i}" for i in range(300))
    texts = [passage + " " + " ".join(f"u{k}_{i}" for i in range(120)) for k in range(60)]
    assert traced(spark, texts, 8) == []


def test_the_most_frequent_shingles_come_last():
    frequent = jaccard_join.frequent_of([(5, 2), (-3, 9), (7, 4)])
    s = np.sort(np.array([5, 6, 7, -3], np.int64).view(np.uint64))
    assert jaccard_join.first(s, 4, frequent).view(np.int64).tolist() == [6, 5, 7, -3]
    assert jaccard_join.first(s, 2, frequent).view(np.int64).tolist() == [6, 5]
