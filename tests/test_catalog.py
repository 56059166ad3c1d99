"""Driver contract: entry() runs, and a sample of queries equals its SQL twin at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SAMPLE = ["normalize_text", "dedup_lines", "redact_pii", "build_vocab", "pack_sequences", "chunk_lines",
          "train_val_split", "pad_dynamic", "tokenizer_eval", "conversation_pairs", "dpo_project",
          "doc_nll", "running_best", "nucleus_filter", "stream_redact", "scan_jsonl_or_text"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["seq_id", "input_ids", "attention_mask"]


def test_every_query_has_callable_and_sql_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = df.collect()
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, srows) == rows_of(rel.columns, drows)
