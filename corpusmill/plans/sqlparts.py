"""SQL (DuckDB dialect) building blocks for the oracle side of the catalog.

They restate the derived inputs of ``inputs.py`` in plain SQL so the oracle
computes every query independently of the Spark code path.
"""

from __future__ import annotations

# Python's whitespace set and the normaliser's classes (same fixed values as functions/text.py)
WS = (r"[\t\n\x0B\x0C\r\x1C-\x20\x{85}\xA0\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
LINE_BREAK = r"\r\n|[\n\x0B\x0C\r\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
EMAIL = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-z]{2,}\b"
PHONE = r"\b(?:\+?\d{1,3}[-. ]?)?(?:\(?\d{3}\)?[-. ]?)?\d{3}[-. ]?\d{4}\b"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def rstrip(e: str) -> str:
    return f"regexp_replace({e}, '{WS}+$', '', 'g')"


def words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '{WS}+'), lambda x: x <> '')"


def normalize(e: str) -> str:
    s = f"replace(nfc_normalize({e}), chr(9), ' ')"
    s = f"regexp_replace({s}, '[ \\xA0]+', ' ', 'g')"
    s = f"regexp_replace({s}, '[\\x00-\\x08\\x0B-\\x1F\\x7F]', '', 'g')"
    return strip(s)


def redact_email(e: str) -> str:
    return f"regexp_replace({e}, '{EMAIL}', '[EMAIL_REDACTED]', 'g')"


def redact_phone(e: str) -> str:
    return f"regexp_replace({e}, '{PHONE}', '[PHONE_REDACTED]', 'g')"


DIRTY = """dirty AS (
  SELECT doc_id,
         CASE WHEN doc_id % 11 = 0 THEN substr(t2, 1, 10) || chr(1) || chr(13) || substr(t2, 11)
              ELSE t2 END AS text
  FROM (SELECT doc_id,
               CASE WHEN doc_id % 7 = 0 THEN replace(t1, ' ', chr(9) || chr(160) || ' ') ELSE t1 END AS t2
        FROM (SELECT doc_id,
                     CASE WHEN doc_id % 5 = 0 THEN replace(text, chr(233), 'e' || chr(769)) ELSE text END AS t1
              FROM documents) a) b)"""

NORM = f"""norm AS (SELECT doc_id, {normalize('text')} AS text FROM dirty)"""
CLEAN = """clean AS (SELECT doc_id, text FROM norm WHERE length(text) >= 32)"""
LINES = """lines AS (
  SELECT doc_id, unnest(generate_series(0, len(p) - 1)) AS line_no, unnest(p) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM clean) s)"""
WORDFREQ = f"""wf AS (
  SELECT w AS word, count(*) AS cnt FROM (SELECT unnest({words('line')}) AS w FROM lines) o GROUP BY w)"""
VOCAB = """vocab AS (
  SELECT word AS piece, CAST(3 + row_number() OVER (ORDER BY cnt DESC, word ASC) AS INTEGER) AS id,
         CAST(cnt AS BIGINT) AS count FROM wf
  UNION ALL SELECT * FROM (VALUES ('<pad>', 0, NULL), ('<s>', 1, NULL), ('</s>', 2, NULL),
                                  ('<unk>', 3, NULL)) v(piece, id, count))"""
TOKS = f"""occ AS (
  SELECT doc_id, line_no, unnest(generate_series(1, len(ws))) AS pos, unnest(ws) AS word
  FROM (SELECT doc_id, line_no, {words('line')} AS ws FROM lines) x),
enc AS (
  SELECT doc_id, line_no, list(id ORDER BY pos) AS ids
  FROM occ JOIN vocab ON occ.word = vocab.piece GROUP BY doc_id, line_no),
toks AS (
  SELECT l.doc_id, l.line_no, CAST(coalesce(e.ids, []) AS INTEGER[]) AS ids
  FROM lines l LEFT JOIN enc e ON l.doc_id = e.doc_id AND l.line_no = e.line_no)"""
WRAPPED = """wrapped AS (
  SELECT doc_id, line_no, CAST(list_concat([1], ids, [2]) AS INTEGER[]) AS ids FROM toks WHERE len(ids) > 0)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


CORPUS = [DIRTY, NORM, CLEAN, LINES]
TOKENS = CORPUS + [WORDFREQ, VOCAB, TOKS]

# the LM dataset: wrapped lines with 1 < len <= BLOCK (set by the catalog)
def dataset(block: int) -> str:
    return f"""ds AS (SELECT doc_id, line_no, ids FROM wrapped WHERE len(ids) > 1 AND len(ids) <= {block})"""


def shuffled(seed: int, epoch: int, batch: int) -> str:
    return f"""shuf AS (
  SELECT doc_id, line_no, ids, CAST(row_number() OVER (
           ORDER BY md5(concat_ws(':', doc_id, line_no, '{seed}', '{epoch}')), doc_id, line_no) AS BIGINT)
         AS position FROM ds),
bat AS (SELECT *, CAST((position - 1) // {batch} AS BIGINT) AS batch_id FROM shuf)"""


PAIRS = """pairs AS (
  SELECT conv_id, turn, text AS prompt, next_text AS response FROM (
    SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) t
  WHERE role = 'user' AND next_role = 'assistant')"""

BIGRAMS = """bigrams AS (
  SELECT CAST(ids[i] AS INTEGER) AS prev_id, CAST(ids[i + 1] AS INTEGER) AS token_id, count(*) AS n
  FROM (SELECT ids, unnest(range(1, len(ids))) AS i FROM wrapped) t GROUP BY 1, 2)"""
