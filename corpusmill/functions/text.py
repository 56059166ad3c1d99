"""Scalar text functions as Spark Column expressions (JVM side, codegen'd).

Only Unicode normalisation and lenient UTF-8 decoding need Python; they live in
``udfs.py`` and are applied to as few rows as possible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .udfs import lenient_utf8_decode, nfc_udf, nfkc_udf

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
#
# Python's str.strip()/str.split() whitespace set:
#   \t \n \v \f \r, U+001C..U+001F, space, U+0085, U+00A0, U+1680,
#   U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000
# Characters str.splitlines() breaks on:
#   \n \v \f \r U+001C U+001D U+001E U+0085 U+2028 U+2029 (and \r\n as one break)
# Control characters removed by the corpus normaliser: U+0000..U+0008, U+000B..U+001F, U+007F
# Spaces collapsed by the corpus normaliser: U+0020 and U+00A0
# E-mail pattern:  \b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-z]{2,}\b   -> [EMAIL_REDACTED]
# Phone pattern:   \b(?:\+?\d{1,3}[-. ]?)?(?:\(?\d{3}\)?[-. ]?)?\d{3}[-. ]?\d{4}\b -> [PHONE_REDACTED]
# Instruction template: <s>[INST] {prompt} [/INST]\n{response}</s>
# Minimum record length after normalisation: 32 code points
# ---------------------------------------------------------------------------
PY_WS_CLASS = (r"[\t\n\x0B\x0C\r\x1C-\x20\x{85}\xA0\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# the same whitespace set as a plain string, for trim(str, chars)
PY_WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
               + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")
LINE_BREAK_PATTERN = r"\r\n|[\n\x0B\x0C\r\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
CONTROL_CLASS = r"[\x00-\x08\x0B-\x1F\x7F]"
SPACE_RUN = r"[ \xA0]+"
EMAIL_PATTERN = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-z]{2,}\b"
PHONE_PATTERN = r"\b(?:\+?\d{1,3}[-. ]?)?(?:\(?\d{3}\)?[-. ]?)?\d{3}[-. ]?\d{4}\b"
EMAIL_TOKEN = "[EMAIL_REDACTED]"
PHONE_TOKEN = "[PHONE_REDACTED]"
SFT_PREFIX = "<s>[INST] "
SFT_MIDDLE = " [/INST]\n"
SFT_SUFFIX = "</s>"
MIN_CHARS = 32

# Java's \b and \d are ASCII-only unless UNICODE_CHARACTER_CLASS is on; Python's
# are Unicode, so the Spark side always runs these with (?U).
_UNICODE = "(?U)"
_NON_ASCII = r"[^\x00-\x7F]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Python ``str.strip()``: plain ``trim`` only removes U+0020, so trim the whole set."""
    return F.trim(_c(col), F.lit(PY_WS_CHARS))


def py_rstrip(col) -> Column:
    return F.rtrim(_c(col), F.lit(PY_WS_CHARS))


def is_blank(col) -> Column:
    """``not line.strip()`` (null counts as blank)."""
    return F.coalesce(py_strip(col) == "", F.lit(True))


def nfc(col) -> Column:
    """Unicode NFC; pure-ASCII rows never leave the JVM (they are already NFC)."""
    c = _c(col)
    return F.coalesce(nfc_udf(F.when(c.rlike(_NON_ASCII), c)), c)


def nfkc(col) -> Column:
    """Unicode NFKC; pure-ASCII rows never leave the JVM."""
    c = _c(col)
    return F.coalesce(nfkc_udf(F.when(c.rlike(_NON_ASCII), c)), c)


def clean_ws_controls(col) -> Column:
    """Steps after NFC of the corpus normaliser, in order: tab -> space,
    collapse runs of space/NBSP, drop control characters (\\n survives), strip."""
    c = F.replace(_c(col), F.lit("\t"), F.lit(" "))
    # text in which every run is one plain space is not searched by the pattern
    c = F.when(F.contains(c, F.lit("  ")) | F.contains(c, F.lit("\u00a0")), F.regexp_replace(c, SPACE_RUN, " ")).otherwise(c)
    c = F.regexp_replace(c, CONTROL_CLASS, "")
    return py_strip(c)


def normalize_text(col) -> Column:
    """NFC -> tab to space -> collapse spaces -> drop controls -> strip."""
    return clean_ws_controls(nfc(col))


def split_lines(col) -> Column:
    """``str.splitlines()`` as an array (no trailing empty element)."""
    parts = F.split(_c(col), LINE_BREAK_PATTERN, -1)
    # a final line break yields one trailing empty string that splitlines() drops
    return F.when(_c(col) == "", F.array().cast("array<string>")).otherwise(
        F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts))


def split_words(col) -> Column:
    """``str.split()`` with no argument: Unicode whitespace runs, no empty words."""
    return F.filter(F.split(_c(col), f"{PY_WS_CLASS}+", -1), lambda w: w != "")


def word_count(col) -> Column:
    return F.size(split_words(col))


def content_hash(col) -> Column:
    """Hex content key of the stripped text (256-bit, collision-safe at any scale)."""
    return F.sha2(py_strip(col), 256)


def redact_email(col) -> Column:
    return F.regexp_replace(_c(col), _UNICODE + EMAIL_PATTERN, EMAIL_TOKEN)


def redact_phone(col) -> Column:
    return F.regexp_replace(_c(col), _UNICODE + PHONE_PATTERN, PHONE_TOKEN)


def redact_pii(col) -> Column:
    """E-mail first, then phone numbers, as the reference redactor does."""
    return redact_phone(redact_email(col))


def decode_lenient(col) -> Column:
    """``bytes.decode('utf-8', errors='ignore')``: invalid bytes are dropped.

    Valid input is decoded in the JVM; only invalid byte strings go to Python.
    ``make_valid_utf8`` would insert U+FFFD instead, which is not the wanted result.
    """
    c = _c(col)
    valid = F.is_valid_utf8(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(valid, c.cast("string")).otherwise(
        lenient_utf8_decode(F.when(~valid, c)))


def sft_text(prompt, response) -> Column:
    """``<s>[INST] {prompt} [/INST]\\n{response}</s>``; null when either side is null."""
    return F.concat(F.lit(SFT_PREFIX), _c(prompt), F.lit(SFT_MIDDLE), _c(response),
                    F.lit(SFT_SUFFIX))
