"""Registered queries without an SQL twin, against Python brute force on whole sf0.001 tables."""

import unicodedata

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from corpusmill.operators import vocab as V
from corpusmill.plans import inputs as I
from test_bpe import reference_bpe


def test_normalize_nfkc_and_clean_lines(spark):
    dirty = {r.doc_id: r.text for r in I.dirty_documents(spark, SF_SMALL).collect()}
    got = {r.doc_id: r.text for r in E.queries()["normalize_nfkc"](spark, SF_SMALL).collect()}
    assert got == {k: unicodedata.normalize("NFKC", v) for k, v in dirty.items()}
    docs = {r.doc_id: r.text for r in I.table(spark, SF_SMALL, "documents").collect()}
    want = []
    for k, text in docs.items():
        lines = unicodedata.normalize("NFKC", text).splitlines()
        want += [(k, i, ln.rstrip()) for i, ln in enumerate(lines) if ln.strip()]
    got_lines = sorted((r.doc_id, r.line_no, r.line) for r in E.queries()["clean_lines"](spark, SF_SMALL).collect())
    assert got_lines == sorted(want)


def test_sample_next_draws_from_nucleus(spark):
    q = E.queries()
    draws = {r.prompt_id: r.next_id for r in q["sample_next"](spark, SF_SMALL).collect()}
    allowed = {}
    for r in q["nucleus_filter"](spark, SF_SMALL).collect():
        allowed.setdefault(r.prompt_id, set()).add(r.token_id)
    assert set(draws) == set(allowed)
    assert all(draws[p] in allowed[p] for p in draws)
    again = {r.prompt_id: r.next_id for r in q["sample_next"](spark, SF_SMALL).collect()}
    assert again == draws


def test_generation_follows_bigrams(spark):
    q = E.queries()
    bigrams = {(r.prev_id, r.token_id) for r in q["ngram_counts"](spark, SF_SMALL).collect()}
    rows = q["generate_ngram"](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        ids = r.ids
        assert ids[0] == 1 and len(ids) == 2 + r.n_generated and r.n_generated <= 16
        assert all((a, b) in bigrams for a, b in zip(ids[1:], ids[2:]))
        assert r.finished == (ids[-1] == 2 or r.n_generated < 16) or r.n_generated == 16


def test_subword_roundtrip_on_corpus(spark):
    r = E.queries()["tokenizer_eval_subword"](spark, SF_SMALL).first()
    words = E.queries()["tokenizer_eval"](spark, SF_SMALL).first()
    # both tokenizers lose exactly the lines whose whitespace is not single spaces
    assert r.n_errors == words.n_errors and r.n_lines == words.n_lines and r.n_words == words.n_words
    assert r.avg_tokens_per_word >= 1.0
    by_bytes = E.queries()["tokenizer_eval_subword_bytes"](spark, SF_SMALL).first()
    assert by_bytes.n_errors == words.n_errors and by_bytes.avg_tokens_per_word >= 1.0
    merges = E.queries()["bpe_train"](spark, SF_SMALL).orderBy("rank").collect()
    assert [m["rank"] for m in merges] == list(range(1, len(merges) + 1)) and len(merges) >= 1000
    counts = [m["count"] for m in merges]
    assert counts == sorted(counts, reverse=True)
    lines = I.corpus_lines(spark, SF_SMALL)
    words = {r["word"]: r["count"] for r in V.word_table(lines, "line").collect()}
    assert [(m["left"], m["right"], m["count"]) for m in merges[:25]] == reference_bpe(words, 25)


def test_unigram_tokenizer_roundtrip(spark):
    r = E.queries()["tokenizer_eval_unigram"](spark, SF_SMALL).first()
    words = E.queries()["tokenizer_eval"](spark, SF_SMALL).first()
    assert r.n_errors == words.n_errors and r.n_lines == words.n_lines
    assert r.avg_tokens_per_word >= 1.0 and r.verdict in ("better", "worse", "equal")
