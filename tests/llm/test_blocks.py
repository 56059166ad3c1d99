"""Crowded regions of the Jaccard join that are compared block by block: all their links, in one round."""

import random

import numpy as np
import pytest

from corpusmill.llm import jaccard_join
from test_text_ops import components, frame


@pytest.mark.parametrize("spread", [8, 4000])
def test_overlaps_and_their_spanning_forest(spread):
    rng = np.random.default_rng(3)
    draw = lambda k: [np.unique(rng.integers(0, spread, rng.integers(1, 60)).astype(np.uint64)) for _ in range(k)]
    left, right = draw(30), draw(41)
    want = np.array([[len(np.intersect1d(a, b)) for b in right] for a in left])
    assert (jaccard_join.overlaps(left, right) == want).all()
    link = want >= np.quantile(want, 0.97)
    names = lambda edges: sorted(sorted(g) for g in groups([(("r", i), ("c", j)) for i, j in edges]))
    got = jaccard_join.spanning(link)
    assert names(got) == names(zip(*np.nonzero(link))) and len(got) < link.any(1).sum() + link.any(0).sum()


def groups(edges):
    of = {}
    for a, b in edges:
        g = of.setdefault(a, {a}) | of.setdefault(b, {b})
        for x in g:
            of[x] = g
    return {id(g): g for g in of.values()}.values()


@pytest.mark.parametrize("block", [256 * 20, jaccard_join.BLOCK])
def test_a_crowd_of_near_copies_takes_one_round(spark, monkeypatch, block):
    """Versions that link with few others each, so that hardly any is near the pivot; before, each round parted one pivot's neighbours."""
    monkeypatch.setattr(jaccard_join.block_links, "__defaults__", (block,))
    rng = random.Random(5)
    texts = []
    for _ in range(90):
        words = [f"w{i}" for i in range(100)]
        for k in rng.sample(range(100), rng.randint(0, 6)):
            words[k] = f"x{rng.randint(0, 3)}"
        texts.append(" ".join(words))
    trace = []
    docs = frame(spark, texts).select("doc_id", "text")
    got = jaccard_join._components(docs, "doc_id", "text", leaf=8, trace=trace, whole=jaccard_join.WHOLE).collect()
    rows = sorted((str(r["id"]), r["n_shingles"], str(r["component_id"])) for r in got)
    assert rows == components(texts, list(range(len(texts)))) and len({r[2] for r in rows}) > 1
    assert len(trace) == 1 and trace[0][2] == 0


def test_sets_go_to_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    with pytest.raises(ValueError), jaccard_join.small_batches(spark):
        assert int(spark.conf.get(name)) <= jaccard_join.BATCH_ROWS
        raise ValueError
    assert spark.conf.get(name) == old
