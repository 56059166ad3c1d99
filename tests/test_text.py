"""Scalar text functions against Python's own behaviour."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalize_removes_controls_after_collapsing(spark):
    # Controls are removed after the space collapse, so two spaces remain
    assert one(spark, T.normalize_text("v"), "a \x01 b") == "a  b"


def test_normalize_full_chain(spark):
    raw = "  été\tx   y\r\nz \x7f "
    ref = unicodedata.normalize("NFC", raw).replace("\t", " ")
    import re
    ref = re.sub("[ \u00a0]+", " ", ref)
    ref = re.sub(r"[\x00-\x08\x0B-\x1F\x7F]", "", ref).strip()
    assert one(spark, T.normalize_text("v"), raw) == ref


@pytest.mark.parametrize("s", ["1234567", "20240131", "1234567890123"])
def test_phone_redacted(spark, s):
    assert one(spark, T.redact_phone("v"), s) == "[PHONE_REDACTED]"


@pytest.mark.parametrize("s", ["123456", "12345678901234", "2024-01-31", "é1234567"])
def test_phone_unchanged(spark, s):
    assert one(spark, T.redact_phone("v"), s) == s


def test_phone_shapes(spark):
    assert one(spark, T.redact_phone("v"), "(555) 123-4567") == "([PHONE_REDACTED]"
    assert one(spark, T.redact_phone("v"), "call +1 555 123 4567") == "call +[PHONE_REDACTED]"
    arabic = "x " + "".join(chr(0x660 + d) for d in [1, 2, 3, 4, 5, 6, 7])
    assert one(spark, T.redact_phone("v"), arabic) == "x [PHONE_REDACTED]"


def test_email_then_phone(spark):
    s = "mail a.b@ex.com or 5551234567"
    assert one(spark, T.redact_pii("v"), s) == "mail [EMAIL_REDACTED] or [PHONE_REDACTED]"
    assert one(spark, T.redact_email("v"), "X@Y.COM") == "X@Y.COM"  # TLD must be lower case


def test_lenient_decode_drops_bad_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb\xc3"),), (bytearray("hé".encode()),)], "b binary")
    got = [r["r"] for r in df.select(T.decode_lenient("b").alias("r")).collect()]
    assert got == ["ab", "hé"]


def test_splitlines(spark):
    s = "a\u0085b c\x0bd\r\ne"
    arr = one(spark, T.split_lines("v"), s)
    assert arr == s.splitlines() == ["a", "b c", "d", "e"]
    for s in ["x\n", "x\n\n", "", "\n", "a\x1cb\x1dc\x1ed e f\x0cg\rh"]:
        assert one(spark, T.split_lines("v"), s) == s.splitlines(), repr(s)


@pytest.mark.parametrize("s", ["  a b  ", "　x ", "\x1c\x1fy\x85", "z", "", " \t\n"])
def test_py_strip_and_words(spark, s):
    assert one(spark, T.py_strip("v"), s) == s.strip()
    assert one(spark, T.py_rstrip("v"), s) == s.rstrip()
    assert one(spark, T.word_count("v"), s) == len(s.split())


def test_nfc_and_nfkc(spark):
    assert one(spark, T.nfc("v"), "é") == "é"
    assert one(spark, T.nfkc("v"), "ﬁx") == "fix"
    assert one(spark, T.nfc("v"), "plain ascii") == "plain ascii"


def test_sft_template(spark):
    df = spark.createDataFrame([("p", "r")], "prompt string, response string")
    assert df.select(T.sft_text("prompt", "response")).first()[0] == "<s>[INST] p [/INST]\nr</s>"
