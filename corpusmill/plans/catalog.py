"""Registered queries: each Spark query next to the SQL that checks it.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over the whole given tables;
``ORACLE[name]`` is DuckDB SQL over the same tables (views named after the
parquet files).  Column names and types are aliased identically on both sides.
Queries without an SQL twin are checked against brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, sequences as Q, text as text_ops, tokenize as tok
from ..operators import bpe, instruct, metrics, neardup, ngram, splits, unigram, vocab as V
from ..sources import corpus, packed as packed_source, sinks
from ..streaming import jobs as streaming
from . import inputs as I
from . import sqlparts as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _lines(spark, sf_dir):
    """The cleaned corpus lines, written once to the shared checkpoint folder so the
    vocabulary pass and the encoding pass do not both redo the cleaning."""
    return sinks.materialize(I.corpus_lines(spark, sf_dir), "lines")


def _vocab(spark, sf_dir, lines=None):
    # materialised: its size decides broadcast vs shuffle join, and it is reused
    lines = lines if lines is not None else _lines(spark, sf_dir)
    return sinks.materialize(V.build_vocab(V.word_table(lines, "line")), "vocab")


def _corpus(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    vocab = _vocab(spark, sf_dir, lines)
    # tokens feed several passes downstream (offsets, counts, ranks): written once
    toks = sinks.materialize(tok.encode_words(lines, vocab, ["doc_id", "line_no"], "line"), "tokens")
    return lines, vocab, toks


def _tokens(spark, sf_dir):
    return _corpus(spark, sf_dir)[2]


# --------------------------------------------------------------------------- text

@register("normalize_text", S.with_(S.DIRTY, S.NORM) + "SELECT doc_id, text FROM norm")
def q_normalize_text(spark, sf_dir):
    return I.normalized_documents(spark, sf_dir)


@register("min_length_filter", S.with_(S.DIRTY, S.NORM, S.CLEAN) + "SELECT doc_id, text FROM clean")
def q_min_length_filter(spark, sf_dir):
    return I.clean_documents(spark, sf_dir)


@register("explode_lines", S.with_(*S.CORPUS) + "SELECT doc_id, line_no, line FROM lines")
def q_explode_lines(spark, sf_dir):
    return I.corpus_lines(spark, sf_dir)


@register("split_lines", f"""
SELECT doc_id, unnest(generate_series(0, len(p) - 1)) AS line_no, unnest(p) AS line
FROM (SELECT doc_id, CASE WHEN text = '' THEN []
             WHEN p0[len(p0)] = '' THEN p0[1:len(p0) - 1] ELSE p0 END AS p
      FROM (SELECT doc_id, text, regexp_split_to_array(text, '{S.LINE_BREAK}') AS p0
            FROM documents) a) b""")
def q_split_lines(spark, sf_dir):
    return text_ops.split_lines(I.table(spark, sf_dir, "documents"))


@register("py_strip", S.with_(S.DIRTY) + f"""
SELECT doc_id, unnest(generate_series(0, len(p) - 1)) AS line_no,
       {S.strip('unnest(p)')} AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM dirty) a""")
def q_py_strip(spark, sf_dir):
    lines = text_ops.explode_lines(I.dirty_documents(spark, sf_dir))
    return lines.withColumn("line", T.py_strip("line"))


@register("word_counts_per_doc", f"""
SELECT doc_id, CAST(len({S.words('text')}) AS BIGINT) AS n_words FROM documents""")
def q_word_counts(spark, sf_dir):
    return text_ops.word_counts(I.table(spark, sf_dir, "documents")).select("doc_id", "n_words")


@register("redact_email", f"SELECT doc_id, {S.redact_email('text')} AS text FROM documents")
def q_redact_email(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", T.redact_email("text").alias("text"))


@register("redact_phone", f"SELECT doc_id, {S.redact_phone('text')} AS text FROM documents")
def q_redact_phone(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", T.redact_phone("text").alias("text"))


@register("redact_pii", f"SELECT doc_id, {S.redact_phone(S.redact_email('text'))} AS text FROM documents")
def q_redact_pii(spark, sf_dir):
    return text_ops.redact(I.table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("content_hash", S.with_(*S.CORPUS) + f"""
SELECT doc_id, line_no, sha256({S.strip('line')}) AS content_hash FROM lines""")
def q_content_hash(spark, sf_dir):
    return I.corpus_lines(spark, sf_dir).select("doc_id", "line_no",
                                                T.content_hash("line").alias("content_hash"))


# --------------------------------------------------------------------------- dedup

@register("dedup_lines", S.with_(*S.CORPUS) + f"""
SELECT doc_id, line_no, line FROM (
  SELECT *, row_number() OVER (PARTITION BY {S.strip('line')} ORDER BY doc_id, line_no) AS rn
  FROM lines) r WHERE rn = 1""")
def q_dedup_lines(spark, sf_dir):
    return dedup.dedup_first(I.corpus_lines(spark, sf_dir), ["doc_id", "line_no"], "line")


@register("dedup_documents", S.with_(S.DIRTY, S.NORM, S.CLEAN) + f"""
SELECT doc_id, text FROM (
  SELECT *, row_number() OVER (PARTITION BY {S.strip('text')} ORDER BY doc_id) AS rn
  FROM clean) r WHERE rn = 1""")
def q_dedup_documents(spark, sf_dir):
    return dedup.dedup_first(I.clean_documents(spark, sf_dir), ["doc_id"], "text")


@register("dedup_stats", S.with_(*S.CORPUS) + f"""
SELECT CAST(sum(c) AS BIGINT) AS n_in, CAST(count(*) AS BIGINT) AS n_out,
       CAST(sum(c) - count(*) AS BIGINT) AS n_removed,
       CAST(count(*) FILTER (WHERE c > 1) AS BIGINT) AS n_dup_keys, CAST(max(c) AS BIGINT) AS max_copies
FROM (SELECT {S.strip('line')} AS k, count(*) AS c FROM lines GROUP BY 1) g""")
def q_dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(I.corpus_lines(spark, sf_dir), "line")


# --------------------------------------------------------------------------- vocabulary

@register("word_freq", S.with_(*S.CORPUS, S.WORDFREQ) + "SELECT word, CAST(cnt AS BIGINT) AS count FROM wf")
def q_word_freq(spark, sf_dir):
    return V.word_table(I.corpus_lines(spark, sf_dir), "line")


@register("build_vocab", S.with_(*S.CORPUS, S.WORDFREQ, S.VOCAB) + "SELECT piece, id, count FROM vocab")
def q_build_vocab(spark, sf_dir):
    return I.vocab(spark, sf_dir)


@register("encode_words", S.with_(*S.TOKENS) + "SELECT doc_id, line_no, ids FROM toks")
def q_encode_words(spark, sf_dir):
    return _tokens(spark, sf_dir)


@register("decode_words", S.with_(*S.TOKENS) + f"""
SELECT doc_id, line_no, array_to_string({S.words('line')}, ' ') AS text FROM lines""")
def q_decode_words(spark, sf_dir):
    _, v, toks = _corpus(spark, sf_dir)
    return tok.decode_words(toks, v, ["doc_id", "line_no"])


@register("offset_clamp", S.with_(*S.TOKENS) + """
SELECT doc_id, line_no, CAST(list_transform(ids, lambda i: least(i + 3, 5000 - 1)) AS INTEGER[]) AS ids
FROM toks""")
def q_offset_clamp(spark, sf_dir):
    return _tokens(spark, sf_dir).select("doc_id", "line_no",
                                         tok.offset_clamp("ids", 5000).alias("ids"))


@register("wrap_special", S.with_(*S.TOKENS, S.WRAPPED) + "SELECT doc_id, line_no, ids FROM wrapped")
def q_wrap_special(spark, sf_dir):
    return I.wrapped_from(_tokens(spark, sf_dir))


# --------------------------------------------------------------------------- sequences

@register("pack_sequences", S.with_(*S.TOKENS) + f""",
rec AS (SELECT doc_id, line_no, list_append(ids, 2) AS t, len(ids) + 1 AS n FROM toks),
pos AS (SELECT t, n, CAST(coalesce(sum(n) OVER (ORDER BY doc_id, line_no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM rec),
flat AS (SELECT unnest(t) AS tok, unnest(generate_series(s, s + n - 1)) AS gpos FROM pos)
SELECT CAST(gpos // {I.SEQ_LEN} AS BIGINT) AS seq_id,
       CAST(list(tok ORDER BY gpos) AS INTEGER[]) AS input_ids,
       CAST(list_transform(list(tok ORDER BY gpos), lambda x: 1) AS TINYINT[]) AS attention_mask
FROM flat GROUP BY 1 HAVING count(*) = {I.SEQ_LEN}""")
def q_pack_sequences(spark, sf_dir):
    return Q.pack(_tokens(spark, sf_dir), seq_len=I.SEQ_LEN)


@register("chunk_lines", S.with_(*S.TOKENS) + f""",
st AS (SELECT doc_id, line_no, ids, unnest(range(0, len(ids) - {I.BLOCK}, {I.BLOCK})) AS s FROM toks)
SELECT doc_id, line_no, CAST(s // {I.BLOCK} AS BIGINT) AS chunk_no,
       CAST(ids[s + 1 : s + {I.BLOCK} + 1] AS INTEGER[]) AS ids FROM st""")
def q_chunk_lines(spark, sf_dir):
    return Q.chunk_lines(_tokens(spark, sf_dir), I.BLOCK)


@register("truncate_sequences", S.with_(*S.TOKENS) + f"""
SELECT doc_id, line_no, CAST(ids[1:{I.BLOCK}] AS INTEGER[]) AS ids FROM toks WHERE len(ids) > 0""")
def q_truncate(spark, sf_dir):
    t = _tokens(spark, sf_dir).filter(F.size("ids") > 0)
    return t.select("doc_id", "line_no", Q.truncate("ids", I.BLOCK).alias("ids"))


@register("truncate_left", S.with_(*S.TOKENS) + f"""
SELECT doc_id, line_no,
       CAST(CASE WHEN len(ids) > {I.BLOCK} THEN ids[len(ids) - {I.BLOCK} + 1:] ELSE ids END AS INTEGER[]) AS ids
FROM toks WHERE len(ids) > 0""")
def q_truncate_left(spark, sf_dir):
    t = _tokens(spark, sf_dir).filter(F.size("ids") > 0)
    return t.select("doc_id", "line_no", Q.truncate_left("ids", I.BLOCK).alias("ids"))


@register("seq_length_filter", S.with_(*S.TOKENS, S.WRAPPED) + f"""
SELECT doc_id, line_no, ids FROM wrapped WHERE len(ids) > 1 AND len(ids) <= {I.BLOCK}""")
def q_seq_length_filter(spark, sf_dir):
    return Q.seq_length_filter(I.wrapped_from(_tokens(spark, sf_dir)), "ids", I.BLOCK)


@register("shift_xy", S.with_(*S.TOKENS, S.WRAPPED) + f"""
SELECT doc_id, line_no, CAST(ids[1:len(ids) - 1] AS INTEGER[]) AS x, CAST(ids[2:] AS INTEGER[]) AS y
FROM wrapped WHERE len(ids) > 1 AND len(ids) <= {I.BLOCK}""")
def q_shift_xy(spark, sf_dir):
    t = Q.seq_length_filter(I.wrapped_from(_tokens(spark, sf_dir)), "ids", I.BLOCK)
    return t.select("doc_id", "line_no", Q.shift_x("ids").alias("x"), Q.shift_y("ids").alias("y"))


@register("pad_fixed", S.with_(*S.TOKENS) + f"""
SELECT doc_id, line_no,
       CAST(list_concat(ids[1:{I.BLOCK}], list_transform(range(greatest({I.BLOCK} - len(ids), 0)),
            lambda i: 0)) AS INTEGER[]) AS ids
FROM toks WHERE len(ids) > 0""")
def q_pad_fixed(spark, sf_dir):
    t = _tokens(spark, sf_dir).filter(F.size("ids") > 0)
    return Q.pad_fixed(t, I.BLOCK)


# --------------------------------------------------------------------------- LM dataset, splits, batches

def _dataset(spark, sf_dir):
    """Wrapped lines with ``1 < len <= BLOCK``: the language-model dataset."""
    return Q.seq_length_filter(I.wrapped_from(_tokens(spark, sf_dir)), "ids", I.BLOCK)


def _batched(spark, sf_dir, dataset=None):
    d = dataset if dataset is not None else _dataset(spark, sf_dir)
    shuf = splits.epoch_shuffle(d, ["doc_id", "line_no"], [0], I.SEED).drop("epoch")
    return splits.assign_batches(shuf, I.BATCH_SIZE)


_DS = [*S.TOKENS, S.WRAPPED, S.dataset(I.BLOCK)]
_BAT = _DS + [S.shuffled(I.SEED, 0, I.BATCH_SIZE)]


@register("train_val_split", S.with_(*_DS) + f"""
SELECT doc_id, line_no, CASE WHEN row_number() OVER (
         ORDER BY md5(concat_ws(':', doc_id, line_no, '{I.SEED}')), doc_id, line_no)
       <= floor(0.95 * count(*) OVER ()) THEN 'train' ELSE 'val' END AS split
FROM ds""")
def q_train_val_split(spark, sf_dir):
    d = _dataset(spark, sf_dir).select("doc_id", "line_no")
    return splits.train_val_split(d, ["doc_id", "line_no"], 0.95, I.SEED)


@register("epoch_shuffle", S.with_(*_DS) + f"""
SELECT doc_id, line_no, CAST(epoch AS INTEGER) AS epoch, CAST(row_number() OVER (PARTITION BY epoch
         ORDER BY md5(concat_ws(':', doc_id, line_no, '{I.SEED}', epoch)), doc_id, line_no) AS BIGINT) AS position
FROM ds, (VALUES (0), (1)) e(epoch)""")
def q_epoch_shuffle(spark, sf_dir):
    d = _dataset(spark, sf_dir).select("doc_id", "line_no")
    return splits.epoch_shuffle(d, ["doc_id", "line_no"], [0, 1], I.SEED)


@register("assign_batches", S.with_(*_BAT) + "SELECT doc_id, line_no, position, batch_id FROM bat")
def q_assign_batches(spark, sf_dir):
    return _batched(spark, sf_dir).select("doc_id", "line_no", "position", "batch_id")


@register("drop_last", S.with_(*_BAT) + f"""
SELECT doc_id, line_no, batch_id FROM bat
WHERE batch_id < (SELECT count(*) FROM bat) // {I.BATCH_SIZE}""")
def q_drop_last(spark, sf_dir):
    d = _dataset(spark, sf_dir)  # counted before it is ranked: the ranking keeps its rows
    return splits.drop_last(_batched(spark, sf_dir, d).select("doc_id", "line_no", "batch_id"), d.count(), I.BATCH_SIZE)


@register("batch_plan", S.with_(*_DS) + f"""
SELECT CAST(n AS BIGINT) AS n_rows, CAST(ceil(n / {I.BATCH_SIZE}) AS BIGINT) AS batches_ceil,
       CAST(n // {I.BATCH_SIZE} AS BIGINT) AS batches_floor,
       CAST(ceil(n / {I.BATCH_SIZE}) AS BIGINT) * 10 // 4 AS optimizer_steps_ref,
       CAST((n // {I.BATCH_SIZE}) * 10 // 4 AS BIGINT) AS optimizer_steps
FROM (SELECT count(*) AS n FROM ds) c""")
def q_batch_plan(spark, sf_dir):
    return splits.batch_plan(_dataset(spark, sf_dir), I.BATCH_SIZE, epochs=10, grad_accum=4)


@register("shard_batches", S.with_(*_BAT) + """
SELECT doc_id, line_no, batch_id, CAST(batch_id % 4 AS INTEGER) AS rank FROM bat""")
def q_shard_batches(spark, sf_dir):
    b = _batched(spark, sf_dir).select("doc_id", "line_no", "batch_id")
    return splits.shard_batches(b, 4)


@register("pad_dynamic", S.with_(*_BAT) + """,
xy AS (SELECT doc_id, line_no, batch_id, ids[1:len(ids) - 1] AS x, ids[2:] AS y FROM bat),
mx AS (SELECT batch_id, max(len(x)) AS m FROM xy GROUP BY 1),
pd AS (SELECT doc_id, line_no, xy.batch_id,
              list_concat(x, list_transform(range(m - len(x)), lambda i: 0)) AS x,
              list_concat(y, list_transform(range(m - len(y)), lambda i: 0)) AS y
       FROM xy JOIN mx ON xy.batch_id = mx.batch_id)
SELECT doc_id, line_no, batch_id, CAST(x AS INTEGER[]) AS x, CAST(y AS INTEGER[]) AS y,
       CAST(list_transform(x, lambda t: CASE WHEN t <> 0 THEN 1 ELSE 0 END) AS TINYINT[]) AS attention_mask
FROM pd""")
def q_pad_dynamic(spark, sf_dir):
    b = _batched(spark, sf_dir)
    xy = b.select("doc_id", "line_no", "batch_id", Q.shift_x("ids").alias("x"), Q.shift_y("ids").alias("y"))
    return Q.pad_dynamic(xy)


@register("padding_waste", S.with_(*_BAT) + f""",
l AS (SELECT batch_id, len(ids) - 1 AS n FROM bat),
parts AS (
  SELECT 'fixed' AS policy, sum(least(n, {I.BLOCK})) AS t, count(*) * {I.BLOCK} AS s FROM l
  UNION ALL
  SELECT 'dynamic', sum(t), sum(c * m) FROM (SELECT batch_id, sum(least(n, {I.BLOCK})) AS t, count(*) AS c,
                                             max(least(n, {I.BLOCK})) AS m FROM l GROUP BY 1) b
  UNION ALL
  SELECT 'packed', t, (t // {I.SEQ_LEN}) * {I.SEQ_LEN} + CASE WHEN t % {I.SEQ_LEN} > 0 THEN {I.SEQ_LEN} ELSE 0 END
  FROM (SELECT sum(n) AS t FROM l) p)
SELECT policy, CAST(t AS BIGINT) AS n_tokens, CAST(s AS BIGINT) AS n_slots, CAST(s - t AS BIGINT) AS n_pad
FROM parts""")
def q_padding_waste(spark, sf_dir):
    b = _batched(spark, sf_dir).select("batch_id", (F.size("ids") - 1).alias("n"))
    return Q.padding_waste(b, "n", "batch_id", I.BLOCK, I.SEQ_LEN)


@register("packed_with_labels", S.with_(*S.TOKENS) + f""",
rec AS (SELECT doc_id, line_no, list_append(ids, 2) AS t, len(ids) + 1 AS n FROM toks),
pos AS (SELECT t, n, CAST(coalesce(sum(n) OVER (ORDER BY doc_id, line_no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM rec),
flat AS (SELECT unnest(t) AS tok, unnest(generate_series(s, s + n - 1)) AS gpos FROM pos),
seqs AS (SELECT gpos // {I.SEQ_LEN} AS seq_id, CAST(list(tok ORDER BY gpos) AS INTEGER[]) AS input_ids
         FROM flat GROUP BY 1 HAVING count(*) = {I.SEQ_LEN})
SELECT input_ids, CAST(list_transform(input_ids, lambda x: 1) AS TINYINT[]) AS attention_mask,
       input_ids AS labels FROM seqs""")
def q_packed_with_labels(spark, sf_dir):
    packed = Q.pack(_tokens(spark, sf_dir), seq_len=I.SEQ_LEN)
    path = sinks.scratch_path(spark, "packed")
    sinks.write_packed(packed, path)
    return packed_source.read_packed(spark, path)


# --------------------------------------------------------------------------- instruction data

@register("conversation_pairs", S.with_(S.PAIRS) + "SELECT conv_id, turn, prompt, response FROM pairs")
def q_conversation_pairs(spark, sf_dir):
    return instruct.conversation_pairs(I.table(spark, sf_dir, "conversations"))


@register("sft_format", S.with_(S.PAIRS) + """
SELECT conv_id, turn, '<s>[INST] ' || prompt || ' [/INST]' || chr(10) || response || '</s>' AS text
FROM pairs""")
def q_sft_format(spark, sf_dir):
    pairs = instruct.conversation_pairs(I.table(spark, sf_dir, "conversations"))
    return instruct.sft_format(pairs).select("conv_id", "turn", "text")


@register("dpo_project", S.with_(S.PAIRS) + """,
r AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS pos, count(*) OVER () AS n FROM pairs)
SELECT a.prompt, a.response AS chosen, b.response AS rejected
FROM r a JOIN r b ON b.pos = CASE WHEN a.pos = a.n THEN 1 ELSE a.pos + 1 END""")
def q_dpo_project(spark, sf_dir):
    pairs = instruct.conversation_pairs(I.table(spark, sf_dir, "conversations"))
    return instruct.dpo_project(instruct.preference_triples(pairs))


@register("conversation_messages", f"""
SELECT conv_id, CAST(to_json({{'model': '{instruct.CHAT_MODEL}',
                         'messages': list({{'role': role, 'content': text}} ORDER BY turn)}}) AS VARCHAR) AS payload
FROM conversations GROUP BY conv_id""")
def q_conversation_messages(spark, sf_dir):
    return instruct.conversation_messages(I.table(spark, sf_dir, "conversations"))


@register("chat_flatten", """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS msg_no,
       role, text AS content FROM conversations""")
def q_chat_flatten(spark, sf_dir):
    payloads = instruct.conversation_messages(I.table(spark, sf_dir, "conversations"))
    return instruct.chat_flatten(payloads)


# --------------------------------------------------------------------------- tokenizer statistics

@register("sentence_sample", S.with_(*S.CORPUS) + f"""
SELECT doc_id, line_no, line, md5(concat_ws(':', doc_id, line_no, '{I.SEED}')) AS sample_key
FROM lines ORDER BY sample_key, doc_id, line_no LIMIT 1000000""")
def q_sentence_sample(spark, sf_dir):
    return V.sentence_sample(I.corpus_lines(spark, sf_dir), ["doc_id", "line_no"], 1_000_000, I.SEED)


_CHARS = """chars AS (
  SELECT ch, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(regexp_extract_all(line, '(?s).')) AS ch
                                                FROM lines) c GROUP BY ch),
cov AS (
  SELECT ch, n, CAST(coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING
                                           AND 1 PRECEDING), 0) AS BIGINT) AS cum_before,
         CAST(sum(n) OVER () AS BIGINT) AS total FROM chars)"""


@register("char_coverage", S.with_(*S.CORPUS, _CHARS) + """
SELECT ch, n, cum_before, total, cum_before * 10000000 < total * 9995000 AS kept FROM cov""")
def q_char_coverage(spark, sf_dir):
    return V.char_coverage(I.corpus_lines(spark, sf_dir), "line", 0.9995)


@register("byte_fallback", S.with_(*S.CORPUS, _CHARS) + r"""
SELECT ch, kept, CASE WHEN kept THEN ch ELSE regexp_replace(upper(hex(encode(ch))), '(..)', '<0x\1>', 'g')
                 END AS pieces
FROM (SELECT ch, cum_before * 10000000 < total * 9995000 AS kept FROM cov) k""")
def q_byte_fallback(spark, sf_dir):
    cov = V.char_coverage(I.corpus_lines(spark, sf_dir), "line", 0.9995)
    return tok.byte_fallback(cov.select("ch", "kept"))


@register("bpe_pair_counts", S.with_(*S.CORPUS, S.WORDFREQ) + """,
sy AS (SELECT regexp_extract_all('▁' || word, '(?s).') AS s, cnt FROM wf)
SELECT s[i] AS "left", s[i + 1] AS "right", CAST(sum(cnt) AS BIGINT) AS n
FROM (SELECT s, cnt, unnest(range(1, len(s))) AS i FROM sy) p GROUP BY 1, 2""")
def q_bpe_pair_counts(spark, sf_dir):
    return V.bpe_pair_counts(V.word_table(I.corpus_lines(spark, sf_dir), "line"))


def _eval_lines(spark, sf_dir):
    lines, v, toks = _corpus(spark, sf_dir)
    dec = tok.decode_words(toks, v, ["doc_id", "line_no"], out="decoded")
    keys = ["doc_id", "line_no"]
    # what is compared goes into the joins as digests, never as whole lines
    lines = lines.select(*keys, T.word_count("line").cast("int").alias("n_words"), T.content_hash("line").alias("__h"),
                         (F.col("line") == "").alias("blank"))
    dec = dec.select(*keys, F.sha2("decoded", 256).alias("__d"))
    per = (lines.join(toks.select(*keys, F.size("ids").alias("n_tokens")), keys).join(dec, keys)
           .select(*keys, "n_tokens", "n_words", (F.col("__d") != F.col("__h")).alias("error"), "blank"))
    return per


_EVAL = """per AS (
  SELECT len(ws) AS n_tokens, len(ws) AS n_words, array_to_string(ws, ' ') <> {strip} AS error,
         line = '' AS blank
  FROM (SELECT line, {words} AS ws FROM lines) w),
rep AS (
  SELECT CAST(count(*) AS BIGINT) AS n_lines,
         CAST(sum(CASE WHEN NOT blank THEN 1 ELSE 0 END) AS BIGINT) AS n_nonblank,
         CAST(sum(CASE WHEN NOT blank THEN n_tokens ELSE 0 END) AS BIGINT) AS n_tokens,
         CAST(sum(CASE WHEN NOT blank THEN n_words ELSE 0 END) AS BIGINT) AS n_words,
         CAST(max(CASE WHEN NOT blank THEN n_tokens ELSE 0 END) AS BIGINT) AS max_tokens_in_line,
         CAST(sum(CASE WHEN NOT blank AND error THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
  FROM per),
report AS (
  SELECT n_lines, n_tokens, n_words, max_tokens_in_line, n_errors,
         round(n_tokens / (n_words + 1e-9), 6) AS avg_tokens_per_word,
         round(1.0 - n_errors / ((n_lines - 1) + 1e-9), 6) AS reconstruction_rate_ref,
         round(CASE WHEN n_nonblank > 0 THEN 1.0 - n_errors / n_nonblank END, 6) AS reconstruction_rate
  FROM rep)""".format(strip=S.strip("line"), words=S.words("line"))


@register("tokenizer_eval", S.with_(*S.CORPUS, _EVAL) + "SELECT * FROM report")
def q_tokenizer_eval(spark, sf_dir):
    return tok.tokenizer_eval(_eval_lines(spark, sf_dir), "n_tokens", "n_words", "error", "blank")


@register("tokenizer_eval_first_n", S.with_(*S.CORPUS) + """,
idx AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS i, count(*) OVER () AS n_all FROM lines),
""" + _EVAL.replace("FROM lines) w)", "FROM idx WHERE i < 5000) w)").replace(
    "round(1.0 - n_errors / ((n_lines - 1) + 1e-9), 6)",
    "round(1.0 - n_errors / ((CASE WHEN (SELECT max(n_all) FROM idx) > 5000 THEN 5000 "
    "ELSE (SELECT max(n_all) FROM idx) - 1 END) + 1e-9), 6)") + "SELECT * FROM report")
def q_tokenizer_eval_first_n(spark, sf_dir):
    """The reference evaluates the first 5000 lines of the file; blank lines use up an index."""
    per = text_ops.line_index(_eval_lines(spark, sf_dir))
    return tok.tokenizer_eval(per, "n_tokens", "n_words", "error", "blank", index_col="line_index",
                              n_lines=5000)


@register("tokenizer_compare", S.with_(*S.CORPUS, _EVAL) + f"""
SELECT *, CAST({tok.BASELINE_TOKENS_PER_WORD} AS DOUBLE) AS base_avg_tokens_per_word,
       CAST({tok.BASELINE_MAX_TOKENS} AS BIGINT) AS base_max_tokens_in_line,
       CAST({tok.BASELINE_RECONSTRUCTION} AS DOUBLE) AS base_reconstruction_rate,
       CASE WHEN avg_tokens_per_word < {tok.BASELINE_TOKENS_PER_WORD}
                 AND reconstruction_rate >= {tok.BASELINE_RECONSTRUCTION} THEN 'better'
            WHEN NOT (reconstruction_rate >= {tok.BASELINE_RECONSTRUCTION}) THEN 'worse'
            WHEN avg_tokens_per_word = {tok.BASELINE_TOKENS_PER_WORD} THEN 'equal'
            ELSE 'worse' END AS verdict,
       max_tokens_in_line > {tok.BASELINE_MAX_TOKENS} AS longer_max_line
FROM report""")
def q_tokenizer_compare(spark, sf_dir):
    return tok.tokenizer_compare(q_tokenizer_eval(spark, sf_dir))


# --------------------------------------------------------------------------- n-gram model and metrics

def _wrapped_tokens(spark, sf_dir):
    """Tokens of the non-blank lines and the vocabulary size."""
    _, v, toks = _corpus(spark, sf_dir)
    return toks.filter(F.size("ids") > 0), v.count()


def _bigrams(spark, sf_dir):
    # the bigram table feeds several passes (top-k threshold, softmax, prefix sums)
    return _pair_counts(_wrapped_tokens(spark, sf_dir)[0])


def _pair_counts(toks):
    return sinks.materialize(ngram.bigram_counts(toks), "bigrams")


_WRAPPED_ALL = [*S.TOKENS, S.WRAPPED]


@register("ngram_counts", S.with_(*_WRAPPED_ALL, S.BIGRAMS) + """
SELECT prev_id, token_id, CAST(n AS BIGINT) AS n FROM bigrams""")
def q_ngram_counts(spark, sf_dir):
    return _bigrams(spark, sf_dir)


_NLL = """vs AS (SELECT count(*) AS v FROM vocab),
ctx AS (SELECT prev_id, sum(n) AS c FROM bigrams GROUP BY 1),
occ2 AS (
  SELECT doc_id, CAST(ids[i] AS INTEGER) AS prev_id, CAST(ids[i + 1] AS INTEGER) AS token_id, count(*) AS k
  FROM (SELECT doc_id, ids, unnest(range(1, len(ids))) AS i FROM wrapped) t GROUP BY 1, 2, 3),
scored AS (
  SELECT o.doc_id, o.k, ln(b.n + 1) - ln(c.c + (SELECT v FROM vs)) AS lp
  FROM occ2 o JOIN bigrams b ON o.prev_id = b.prev_id AND o.token_id = b.token_id
       JOIN ctx c ON o.prev_id = c.prev_id),
nll AS (
  SELECT doc_id, CAST(sum(k) AS BIGINT) AS n_tokens, -sum(k * lp) AS s FROM scored GROUP BY 1),
metrics AS (
  SELECT d.lang AS run, nll.doc_id AS step, CAST(nll.doc_id % 4 AS INTEGER) AS epoch,
         round(s / n_tokens, 9) AS loss, n_tokens, nll.doc_id // 16 AS batch_id
  FROM nll JOIN documents d ON d.doc_id = nll.doc_id)"""


def _metrics(spark, sf_dir):
    toks, vsize = _wrapped_tokens(spark, sf_dir)
    # losses rounded to 9 digits so that exact ties (duplicate documents) stay ties
    scores = ngram.doc_nll(toks, _pair_counts(toks), vsize, digits=9)
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return scores.join(docs, "doc_id").select(
        F.col("lang").alias("run"), F.col("doc_id").alias("step"),
        (F.col("doc_id") % 4).cast("int").alias("epoch"), "loss", "n_tokens",
        F.floor(F.col("doc_id") / 16).cast("long").alias("batch_id"))


@register("doc_nll", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _NLL) + """
SELECT doc_id, n_tokens, round(s, 3) AS nll, round(s / n_tokens, 6) AS loss FROM nll""")
def q_doc_nll(spark, sf_dir):
    toks, vsize = _wrapped_tokens(spark, sf_dir)
    d = ngram.doc_nll(toks, _pair_counts(toks), vsize, digits=12)
    return d.select("doc_id", "n_tokens", F.round("nll", 3).alias("nll"), F.round("loss", 6).alias("loss"))


@register("perplexity_weighted", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _NLL) + """
SELECT run, CAST(sum(n_tokens) AS BIGINT) AS n_tokens, round(sum(loss * n_tokens) / sum(n_tokens), 6) AS loss,
       round(exp(sum(loss * n_tokens) / sum(n_tokens)), 6) AS perplexity
FROM metrics GROUP BY run""")
def q_perplexity_weighted(spark, sf_dir):
    return metrics.perplexity_weighted(_metrics(spark, sf_dir))


@register("perplexity_batch_mean", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _NLL) + """
SELECT run, CAST(count(*) AS BIGINT) AS n_batches, round(avg(bl), 6) AS loss, round(exp(avg(bl)), 6) AS perplexity
FROM (SELECT run, batch_id, sum(loss * n_tokens) / sum(n_tokens) AS bl FROM metrics GROUP BY 1, 2) b
GROUP BY run""")
def q_perplexity_batch_mean(spark, sf_dir):
    return metrics.perplexity_batch_mean(_metrics(spark, sf_dir))


@register("epoch_loss", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _NLL) + """
SELECT run, epoch, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
       round(sum(loss * n_tokens) / sum(n_tokens), 6) AS loss
FROM metrics GROUP BY run, epoch""")
def q_epoch_loss(spark, sf_dir):
    return metrics.epoch_loss(_metrics(spark, sf_dir))


@register("running_best", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _NLL) + """
SELECT run, step, round(loss, 6) AS loss, round(best_before, 6) AS best_before,
       best_before IS NULL OR loss < best_before AS is_best
FROM (SELECT *, min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             AS best_before FROM metrics) m""")
def q_running_best(spark, sf_dir):
    r = metrics.running_best(_metrics(spark, sf_dir))
    return r.select("run", "step", F.round("loss", 6).alias("loss"),
                    F.round("best_before", 6).alias("best_before"), "is_best")


@register("retain_latest", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _NLL) + """
SELECT run, step FROM (SELECT run, step, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS r
                       FROM metrics) m WHERE r <= 3""")
def q_retain_latest(spark, sf_dir):
    return metrics.retain_latest(_metrics(spark, sf_dir), 3)


@register("metrics_interval", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _NLL) + """
SELECT run, step, round(loss, 6) AS loss FROM metrics WHERE step % 50 = 0 AND step > 0""")
def q_metrics_interval(spark, sf_dir):
    m = metrics.metrics_interval(_metrics(spark, sf_dir), 50)
    return m.select("run", "step", F.round("loss", 6).alias("loss"))


# --------------------------------------------------------------------------- sampling filters

_CANDS = """cands AS (SELECT prev_id AS prompt_id, token_id, ln(n) AS logit FROM bigrams)"""


@register("softmax_temperature", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _CANDS) + """,
z AS (SELECT prompt_id, token_id, logit / 0.8 - max(logit / 0.8) OVER (PARTITION BY prompt_id) AS z FROM cands)
SELECT prompt_id, token_id, round(exp(z) / sum(exp(z)) OVER (PARTITION BY prompt_id), 6) AS prob FROM z""")
def q_softmax_temperature(spark, sf_dir):
    p = ngram.softmax_temperature(ngram.candidates(_bigrams(spark, sf_dir)), 0.8)
    return p.select("prompt_id", "token_id", F.round("prob", 6).alias("prob"))


@register("topk_ties", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _CANDS) + """
SELECT prompt_id, token_id, round(logit, 6) AS logit
FROM (SELECT *, rank() OVER (PARTITION BY prompt_id ORDER BY logit DESC) AS r FROM cands) c WHERE r <= 50""")
def q_topk_ties(spark, sf_dir):
    t = ngram.topk_ties(ngram.candidates(_bigrams(spark, sf_dir)), 50)
    return t.select("prompt_id", "token_id", F.round("logit", 6).alias("logit"))


@register("topk_exact", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _CANDS) + """
SELECT prompt_id, token_id, round(logit, 6) AS logit
FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY logit DESC, token_id) AS r FROM cands) c
WHERE r <= 50""")
def q_topk_exact(spark, sf_dir):
    t = ngram.topk_exact(ngram.candidates(_bigrams(spark, sf_dir)), 50)
    return t.select("prompt_id", "token_id", F.round("logit", 6).alias("logit"))


@register("nucleus_filter", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _CANDS) + """,
tk AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY prompt_id ORDER BY logit DESC) AS r FROM cands) c
       WHERE r <= 50),
z AS (SELECT prompt_id, token_id, logit / 0.8 - max(logit / 0.8) OVER (PARTITION BY prompt_id) AS z FROM tk),
pr AS (SELECT prompt_id, token_id, exp(z) / sum(exp(z)) OVER (PARTITION BY prompt_id) AS prob FROM z),
cm AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY prompt_id ORDER BY prob DESC, token_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mass_before FROM pr)
SELECT prompt_id, token_id, round(prob, 6) AS prob FROM cm WHERE mass_before <= 0.9 + 1e-9""")
def q_nucleus_filter(spark, sf_dir):
    tk = ngram.topk_ties(ngram.candidates(_bigrams(spark, sf_dir)), 50)
    pr = ngram.softmax_temperature(tk, 0.8)
    kept = ngram.nucleus_filter(pr, 0.9)
    return kept.select("prompt_id", "token_id", F.round("prob", 6).alias("prob"))


@register("sample_next", S.with_(*_WRAPPED_ALL, S.BIGRAMS, _CANDS) + f""",
tk AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY prompt_id ORDER BY logit DESC) AS r FROM cands) c
       WHERE r <= 50),
z AS (SELECT prompt_id, token_id, logit / 0.8 - max(logit / 0.8) OVER (PARTITION BY prompt_id) AS z FROM tk),
pr AS (SELECT prompt_id, token_id, exp(z) / sum(exp(z)) OVER (PARTITION BY prompt_id) AS prob FROM z),
cm AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY prompt_id ORDER BY prob DESC, token_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mass_before FROM pr),
kept AS (SELECT * FROM cm WHERE mass_before <= 0.9 + 1e-9),
u AS (SELECT prompt_id, token_id, prob,
             (CAST('0x' || substr(md5(concat_ws(':', prompt_id, token_id, '{I.SEED}')), 1, 13) AS UBIGINT)
              + 0.5) / {float(1 << 52)} AS u FROM kept)
SELECT prompt_id, arg_max(token_id, ln(prob) - ln(-ln(u))) AS next_id FROM u GROUP BY prompt_id""")
def q_sample_next(spark, sf_dir):
    tk = ngram.topk_ties(ngram.candidates(_bigrams(spark, sf_dir)), 50)
    pr = ngram.nucleus_filter(ngram.softmax_temperature(tk, 0.8), 0.9)
    return ngram.sample_next(pr, I.SEED)


# --------------------------------------------------------------------------- streaming

CONV_SCHEMA = "conv_id long, turn long, role string, text string"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EVENT_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                "props string")


def _table_stream(spark, sf_dir, name, schema):
    """A table as a stream: one parquet file, or a folder of them as large tables are."""
    return spark.readStream.schema(schema).parquet(_table_path(sf_dir, name))


def _table_path(sf_dir, name):
    # as a glob, since the file stream takes a plain path for a folder
    return f"{sf_dir}/{name}.parque[t]"


@register("stream_redact", f"""
SELECT conv_id, turn, {S.redact_phone(S.redact_email('text'))} AS text FROM conversations""")
def q_stream_redact(spark, sf_dir):
    events = streaming.request_stream(spark, _table_path(sf_dir, "conversations"), CONV_SCHEMA, body_col="text")
    out = streaming.run_available_now(streaming.redact_stream(events).select("conv_id", "turn", "text"),
                                      "redact")
    return spark.read.parquet(out)


@register("stream_normalize", S.with_(S.DIRTY, S.NORM, S.CLEAN) + "SELECT doc_id, text FROM clean")
def q_stream_normalize(spark, sf_dir):
    docs = _table_stream(spark, sf_dir, "documents", DOC_SCHEMA)
    dirty = I._dirty(docs.select("doc_id", "text"))
    out = streaming.run_available_now(streaming.normalize_stream(dirty), "normalize")
    return spark.read.parquet(out)


@register("stream_dedup", "SELECT DISTINCT props FROM events")
def q_stream_dedup(spark, sf_dir):
    ev = _table_stream(spark, sf_dir, "events", EVENT_SCHEMA)
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    dd = streaming.dedup_stream(ev, ["props"])  # exact: no watermark
    out = streaming.run_available_now(dd.select("props"), "dedup")
    return spark.read.parquet(out)


@register("stream_dedup_lines", S.with_(*S.CORPUS) + f"""
SELECT DISTINCT sha256({S.strip('line')}) AS content_hash FROM lines""")
def q_stream_dedup_lines(spark, sf_dir):
    docs = _table_stream(spark, sf_dir, "documents", DOC_SCHEMA)
    clean = streaming.normalize_stream(I._dirty(docs.select("doc_id", "text")))
    lines = text_ops.explode_lines(clean).select(T.content_hash("line").alias("content_hash"))
    out = streaming.run_available_now(streaming.dedup_stream(lines, ["content_hash"]), "dedup-lines")
    return spark.read.parquet(out)


# --------------------------------------------------------------------------- more text, scans

@register("normalize_nfc", S.with_(S.DIRTY) + "SELECT doc_id, nfc_normalize(text) AS text FROM dirty")
def q_normalize_nfc(spark, sf_dir):
    return I.dirty_documents(spark, sf_dir).select("doc_id", T.nfc("text").alias("text"))


@register("normalize_nfkc")
def q_normalize_nfkc(spark, sf_dir):
    return I.dirty_documents(spark, sf_dir).select("doc_id", T.nfkc("text").alias("text"))


@register("clean_lines")
def q_clean_lines(spark, sf_dir):
    return text_ops.clean_lines(I.table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("target_tokens", S.with_(*_BAT) + """
SELECT batch_id, CAST(sum(len(ids) - 1) AS BIGINT) AS n_targets FROM bat GROUP BY batch_id""")
def q_target_tokens(spark, sf_dir):
    b = _batched(spark, sf_dir)
    xy = b.select("doc_id", "line_no", "batch_id", Q.shift_x("ids").alias("x"), Q.shift_y("ids").alias("y"))
    padded = Q.pad_dynamic(xy)
    return padded.groupBy("batch_id").agg(F.sum(Q.count_non_pad("y")).cast("long").alias("n_targets"))


_CONV_LINES = f"""cl AS (
  SELECT {S.normalize(S.strip('l'))} AS text
  FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM conversations) c
  WHERE {S.strip('l')} <> '')"""


@register("scan_jsonl_or_text", S.with_(S.DIRTY, S.NORM, S.CLEAN, _CONV_LINES) + """
SELECT text FROM clean UNION ALL SELECT text FROM cl WHERE length(text) >= 32""")
def q_scan_jsonl_or_text(spark, sf_dir):
    """The dirty documents as JSONL plus conversation texts as a plain text file,
    written by Spark and read back by the JSONL-or-text scan (S1, S2)."""
    jsonl = sinks.scratch_path(spark, "corpus-jsonl")
    txt = sinks.scratch_path(spark, "corpus-txt")
    docs = I.dirty_documents(spark, sf_dir)
    docs.select(F.to_json(F.struct("text")).alias("value")).write.text(jsonl)
    I.table(spark, sf_dir, "conversations").select(F.col("text").alias("value")).write.text(txt)
    return corpus.read_corpus(spark, [jsonl, txt]).select("text")


@register("sft_scan", S.with_(S.PAIRS) + "SELECT prompt, response FROM pairs")
def q_sft_scan(spark, sf_dir):
    path = sinks.scratch_path(spark, "sft-jsonl")
    pairs = instruct.conversation_pairs(I.table(spark, sf_dir, "conversations"))
    pairs.select("prompt", "response").write.json(path)
    return corpus.read_sft(spark, path)


@register("dpo_scan", S.with_(S.PAIRS) + """,
r AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS pos, count(*) OVER () AS n FROM pairs)
SELECT a.prompt, a.response AS chosen, b.response AS rejected
FROM r a JOIN r b ON b.pos = CASE WHEN a.pos = a.n THEN 1 ELSE a.pos + 1 END""")
def q_dpo_scan(spark, sf_dir):
    path = sinks.scratch_path(spark, "dpo-jsonl")
    pairs = instruct.conversation_pairs(I.table(spark, sf_dir, "conversations"))
    instruct.dpo_project(instruct.preference_triples(pairs)).write.json(path)
    return corpus.read_preferences(spark, path)


# --------------------------------------------------------------------------- near duplicates

_NEARDUP = "WITH RECURSIVE " + S.with_(S.DIRTY, S.NORM, S.CLEAN)[len("WITH "):] + f""",
w AS (SELECT doc_id, {S.words('text')} AS w FROM clean),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[s + 1:s + 5], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 5, 0) + 1)) AS s FROM w WHERE len(w) > 0) x),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
inter AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
          FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
pairs AS (SELECT a, b FROM inter JOIN sz sa ON sa.doc_id = a JOIN sz sb ON sb.doc_id = b
          WHERE i / (sa.n + sb.n - i) >= 0.8),
edges AS (SELECT a AS src, b AS dst FROM pairs UNION SELECT b, a FROM pairs),
reach(node, label) AS (
  SELECT src, src FROM edges
  UNION
  SELECT e.dst, r.label FROM reach r JOIN edges e ON r.node = e.src),
clusters AS (SELECT node AS doc_id, min(label) AS cluster_id FROM reach GROUP BY node)
"""


@register("near_dup_pairs")
def q_near_dup_pairs(spark, sf_dir):
    docs = sinks.materialize(I.clean_documents(spark, sf_dir), "clean-docs")
    pairs = neardup.near_duplicate_pairs(docs)
    return pairs.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@register("near_dup_clusters", _NEARDUP + "SELECT doc_id, cluster_id FROM clusters")
def q_near_dup_clusters(spark, sf_dir):
    docs = sinks.materialize(I.clean_documents(spark, sf_dir), "clean-docs")
    comps = neardup.connected_components(neardup.near_duplicate_pairs(docs))
    return comps.select(F.col("node").alias("doc_id"), F.col("label").alias("cluster_id"))


@register("near_dup_drop", _NEARDUP + """
SELECT doc_id, text FROM clean WHERE doc_id NOT IN (SELECT doc_id FROM clusters WHERE doc_id <> cluster_id)""")
def q_near_dup_drop(spark, sf_dir):
    docs = sinks.materialize(I.clean_documents(spark, sf_dir), "clean-docs")
    return neardup.drop_near_duplicates(docs, neardup.near_duplicate_pairs(docs))


# --------------------------------------------------------------------------- subword tokenizer

# Vocabulary size and character coverage of the trained tokenizers
VOCAB_SIZE = 32_000
COVERAGE = 0.9995
# merges that the SQL twin of the training computes: one recount of all pairs each
FIRST_MERGES = 20


def _training_words(lines):
    """Word frequencies of all lines."""
    return sinks.materialize(V.word_table(lines, "line"), "words")


def _bpe(spark, sf_dir, coverage=1.0, byte_pieces=False):
    """Lines, merges and vocabulary of :data:`VOCAB_SIZE` pieces (fewer if no pair is left)."""
    lines = _lines(spark, sf_dir)
    words = _training_words(lines)
    symbols = bpe.alphabet(words, coverage=coverage)
    room = VOCAB_SIZE - 4 - len(symbols) - (256 if byte_pieces else 0)
    merges = sinks.materialize(bpe.train_bpe(words, room, symbols=symbols), "merges")
    return lines, merges, bpe.bpe_vocab(words, merges, symbols=symbols, byte_pieces=byte_pieces)


def _merge_sql(col: str, i: int) -> str:
    """Apply merge ``b{i}`` to a wrapped symbol string (unchanged when there is no merge)."""
    pat = f"(SELECT chr(1) || l || chr(2) || chr(1) || r || chr(2) FROM b{i})"
    rep = f"(SELECT chr(1) || l || r || chr(2) FROM b{i})"
    return f"coalesce(replace({col}, {pat}, {rep}), {col})"


_WRAP_WORD = """list_reduce(list_transform(regexp_extract_all('▁' || {w}, '(?s).'),
                                   lambda c: chr(1) || c || chr(2)), lambda a, b: a || b)"""
_SYMS = "regexp_extract_all({w}, chr(1) || '([^' || chr(2) || ']*)' || chr(2), 1)"


def _bpe_sql(num_merges: int) -> str:
    """BPE merges in SQL: each word is a string of symbols wrapped in chr(1)...chr(2), so a
    plain ``replace`` merges non-overlapping occurrences left to right."""
    parts = [S.with_(*S.CORPUS, S.WORDFREQ)[len("WITH "):] + f""",
w0 AS (SELECT {_WRAP_WORD.format(w="word")} AS w, cnt FROM wf)"""]
    syms = _SYMS.format(w="w")
    for i in range(num_merges):
        parts.append(f"""p{i} AS (
  SELECT s[j] AS l, s[j + 1] AS r, sum(cnt) AS n
  FROM (SELECT s, cnt, unnest(range(1, len(s))) AS j FROM (SELECT {syms} AS s, cnt FROM w{i}) x) y
  GROUP BY 1, 2),
b{i} AS (SELECT {i + 1} AS rank, l, r, n FROM p{i} ORDER BY n DESC, l, r LIMIT 1),
w{i + 1} AS (SELECT {_merge_sql("w", i)} AS w, cnt FROM w{i})""")
    union = " UNION ALL ".join(f"SELECT * FROM b{i}" for i in range(num_merges))
    parts.append(f"""merges AS (
  SELECT CAST(rank AS INTEGER) AS rank, l AS "left", r AS "right", l || r AS piece, CAST(n AS BIGINT) AS count
  FROM ({union}) m)""")
    return "WITH " + ",\n".join(parts) + "\nSELECT * FROM merges"


@register("bpe_train")
def q_bpe_train(spark, sf_dir):
    return _bpe(spark, sf_dir)[1]


@register("bpe_first_merges", _bpe_sql(FIRST_MERGES))
def q_bpe_first_merges(spark, sf_dir):
    """The head of the training, which SQL can follow: a report of the first merges over all lines."""
    return bpe.train_bpe(_training_words(_lines(spark, sf_dir)), FIRST_MERGES)


@register("encode_subword")
def q_encode_subword(spark, sf_dir):
    lines, merges, vocab = _bpe(spark, sf_dir)
    return bpe.encode_subword(lines, merges, vocab, ["doc_id", "line_no"])


@register("encode_subword_bytes")
def q_encode_subword_bytes(spark, sf_dir):
    """With the covered alphabet only; other characters become byte pieces."""
    lines, merges, vocab = _bpe(spark, sf_dir, COVERAGE, byte_pieces=True)
    return bpe.encode_subword(lines, merges, vocab, ["doc_id", "line_no"], byte_pieces=True)


def _subword_report(lines, toks, vocab):
    keys = ["doc_id", "line_no"]
    # decoded as they are encoded; what is compared goes into the join as digests, never as whole lines
    dec = bpe.decode_subword(toks.select(*keys, "ids", F.size("ids").alias("n_tokens")), vocab, [*keys, "n_tokens"], out="decoded",
                             keys_differ=True).select(*keys, "n_tokens", F.sha2("decoded", 256).alias("__d"))
    lines = lines.select(*keys, T.word_count("line").alias("n_words"), T.content_hash("line").alias("__h"),
                         (F.col("line") == "").alias("blank"))
    per = lines.join(dec, keys).select("n_tokens", "n_words", (F.col("__d") != F.col("__h")).alias("error"), "blank")
    return tok.tokenizer_eval(per, "n_tokens", "n_words", "error", "blank")


@register("tokenizer_eval_subword")
def q_tokenizer_eval_subword(spark, sf_dir):
    lines, merges, vocab = _bpe(spark, sf_dir)
    return _subword_report(lines, bpe.encode_subword(lines, merges, vocab, ["doc_id", "line_no"]), vocab)


@register("tokenizer_eval_subword_bytes")
def q_tokenizer_eval_subword_bytes(spark, sf_dir):
    lines, merges, vocab = _bpe(spark, sf_dir, COVERAGE, byte_pieces=True)
    return _subword_report(lines, bpe.encode_subword(lines, merges, vocab, ["doc_id", "line_no"], byte_pieces=True), vocab)


def _generate_sql(max_len: int = 16) -> str:
    base = S.with_(*_WRAPPED_ALL, S.BIGRAMS, _CANDS) + """,
tk AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY prompt_id ORDER BY logit DESC) AS r FROM cands) c
       WHERE r <= 50),
z AS (SELECT prompt_id, token_id, logit / 0.8 - max(logit / 0.8) OVER (PARTITION BY prompt_id) AS z FROM tk),
pr AS (SELECT prompt_id, token_id, exp(z) / sum(exp(z)) OVER (PARTITION BY prompt_id) AS prob FROM z),
cm AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY prompt_id ORDER BY prob DESC, token_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mass_before FROM pr),
kept AS (SELECT prompt_id, token_id, prob, mass_before FROM cm WHERE mass_before <= 0.9 + 1e-9),
ivl AS (SELECT prompt_id, token_id, mass_before / max(mass_before + prob) OVER (PARTITION BY prompt_id) AS lo
        FROM kept),
g0 AS (SELECT doc_id AS seq_id, CAST([1, ids[1]] AS INTEGER[]) AS ids, 0 AS n_generated, false AS finished
       FROM toks WHERE line_no = 0 AND len(ids) > 0)"""
    steps = []
    for i in range(max_len):
        u = (f"(CAST('0x' || substr(md5(concat_ws(':', g.seq_id, {i}, '{I.SEED}')), 1, 13)"
             f" AS UBIGINT) + 0.5) / {float(1 << 52)}")
        steps.append(f"""d{i + 1} AS (
  SELECT g.seq_id, arg_max(k.token_id, k.lo) AS nxt
  FROM g{i} g JOIN ivl k ON k.prompt_id = g.ids[len(g.ids)] AND k.lo <= {u}
  WHERE NOT g.finished GROUP BY g.seq_id),
g{i + 1} AS (
  SELECT g.seq_id,
         CASE WHEN g.finished OR d.nxt IS NULL THEN g.ids ELSE list_append(g.ids, CAST(d.nxt AS INTEGER)) END AS ids,
         g.n_generated + CASE WHEN NOT g.finished AND d.nxt IS NOT NULL THEN 1 ELSE 0 END AS n_generated,
         g.finished OR d.nxt IS NULL OR d.nxt = 2 AS finished
  FROM g{i} g LEFT JOIN d{i + 1} d ON g.seq_id = d.seq_id)""")
    final = f"""
SELECT g.seq_id, CAST(g.ids AS INTEGER[]) AS ids, CAST(g.n_generated AS INTEGER) AS n_generated, g.finished,
       coalesce((SELECT string_agg(v.piece, ' ' ORDER BY t.k)
                 FROM (SELECT unnest(g.ids) AS id, unnest(range(len(g.ids))) AS k) t
                 JOIN vocab v ON v.id = t.id WHERE t.id > 2), '') AS text
FROM g{max_len} g"""
    return base + ",\n" + ",\n".join(steps) + final


@register("generate_ngram", _generate_sql(16))
def q_generate_ngram(spark, sf_dir):
    """One continuation per document, prompted with BOS and the document's first word."""
    lines, v, toks = _corpus(spark, sf_dir)
    wrapped = toks.filter(F.size("ids") > 0)
    # the counts, the candidates and their probabilities feed several passes each: written once
    tk = sinks.materialize(ngram.topk_ties(ngram.candidates(_pair_counts(wrapped)), 50), "top-candidates")
    pr = sinks.materialize(ngram.softmax_temperature(tk, 0.8), "probabilities")
    probs = sinks.materialize(ngram.nucleus_filter(pr, 0.9), "sampling")
    first = wrapped.filter(F.col("line_no") == 0).select(
        F.col("doc_id").alias("seq_id"), F.array(F.lit(1), F.element_at("ids", 1)).alias("ids"))
    gen = ngram.generate(first, probs, max_len=16, seed=I.SEED)
    text = tok.decode_words(gen.select("seq_id", "ids"), v, ["seq_id"])
    return gen.join(text, "seq_id").select("seq_id", "ids", "n_generated", "finished", "text")


@register("unigram_train")
def q_unigram_train(spark, sf_dir):
    words = _training_words(_lines(spark, sf_dir))
    pieces = unigram.train_unigram(words, vocab_size=2000, em_iters=2)
    return pieces.select("piece", F.round("logp", 6).alias("logp"), F.round("expected", 3).alias("expected"))


def _unigram(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    words = _training_words(lines)
    pieces = sinks.materialize(unigram.train_unigram(words, vocab_size=2000, em_iters=2), "unigram")
    return lines, pieces, unigram.unigram_vocab(pieces)


@register("encode_unigram")
def q_encode_unigram(spark, sf_dir):
    lines, pieces, vocab = _unigram(spark, sf_dir)
    return unigram.encode_unigram(lines, pieces, vocab, ["doc_id", "line_no"])


@register("tokenizer_eval_unigram")
def q_tokenizer_eval_unigram(spark, sf_dir):
    lines, pieces, vocab = _unigram(spark, sf_dir)
    toks = unigram.encode_unigram(lines, pieces, vocab, ["doc_id", "line_no"])
    return tok.tokenizer_compare(_subword_report(lines, toks, vocab))
