"""Personal data by patterns, checksums and context (DataFrame operations only).

Regular expressions propose spans (leftmost, not overlapping within a kind); validators confirm
them: numeric range of address parts, Luhn for cards, digit count for phones, mod-97 for
international bank accounts.  Words near a confirmed span move its score.

Spans are found inside the row, without a shuffle: ``regexp_extract_all`` gives the matches
and ``split`` by the same pattern the stretches between them; running sums of their
lengths, in blocks so that long arrays stay linear, are the offsets in code points.
Patterns are written with possessive quantifiers and may only begin where a run of their
characters begins (or where the last match ended), so no text makes them quadratic or
overflows the matcher's stack; they match exactly what the plain patterns match.

Nulls and edge cases: a null or empty text has no spans; a null id is carried through;
repeated rows are scanned each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MAIL = "A-Za-z0-9._%+-"
#: kind -> pattern; the order is the order of the kinds in span lists
PATTERNS = {
    "email": rf"(?:(?<![{_MAIL}])|\G)[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
}
BASE_KINDS = ("email", "ip", "card", "phone")
#: a cheap test that a text can hold the kind at all
HINTS = {"email": "@", "phone": "+"}
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": r"(?i)\b(mail|e-mail|email|contact|write|send)",
    "ip": r"(?i)\b(ip|address|host|server|login|client)",
    "card": r"(?i)\b(card|visa|mastercard|credit|debit|payment|pay)",
    "phone": r"(?i)\b(phone|call|tel|mobile|fax|ring|contact)",
    "iban": r"(?i)\b(iban|account|bank|transfer|konto|compte|cuenta)",
}
#: words that make a span less likely to be somebody's
DOUBT = r"(?i)\b(example|sample|test|dummy|version|isbn|order|invoice)"
WINDOW = 40
BLOCK = 128


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    """Luhn checksum of a string of digits."""
    at = F.sequence(F.lit(0), F.length(digits) - 1)

    def part(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(at, F.lit(0), lambda acc, i: acc + part(i)) % 10 == 0


def mod97_ok(value: Column) -> Column:
    """ISO 7064 mod-97 of an account number (letters count 10 to 35, first four characters last)."""
    flat = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 4))
    code = lambda c: F.ascii(c)
    step = lambda acc, c: F.when(code(c) >= 65, (acc * 100 + code(c) - 55) % 97).otherwise(
        (acc * 10 + code(c) - 48) % 97)
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        n = F.length(_digits(value))
        return F.when((n >= 16) & (n <= 19), luhn_ok(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return mod97_ok(value)
    return F.lit(True)


def _running(values: Column, start: Column) -> Column:
    """``start`` and ``start`` plus each running sum: one more element than ``values``."""
    return F.aggregate(values, F.array(start), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


def running_sums(values: Column, block: int = BLOCK) -> Column:
    """Sum of all values before each one, by blocks: the copying of arrays stays near linear."""
    n = F.size(values)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")),
                         lambda b: F.slice(values, b * block + 1, F.lit(block)))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, v: acc + v))
    return F.flatten(F.zip_with(blocks, F.slice(_running(sums, F.lit(0)), F.lit(1), F.size(sums)),
                                lambda b, s: F.slice(_running(b, s), F.lit(1), F.size(b))))


SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def _spans_of(kind: str, m: Column, g: Column, o: Column) -> Column:
    """Confirmed spans of a kind from its matches, the gaps around them and the offsets of the gaps."""

    def span(i):
        start = F.get(o, i) + F.length(F.get(g, i))
        value = F.get(m, i)
        near = F.concat(F.right(F.get(g, i), F.lit(WINDOW)), F.lit(" "), F.left(F.get(g, i + 1), F.lit(WINDOW)))
        score = (F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), 0.2).otherwise(0.0)
                 - F.when(near.rlike(DOUBT), 0.3).otherwise(0.0))
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
                        value.alias("value"), F.least(score, F.lit(1.0)).alias("score"))

    good = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: valid(kind, F.get(m, i)))
    return F.when(F.size(m) > 0, F.transform(good, span)).otherwise(F.array().cast(SPAN))


def find_spans(docs: DataFrame, text_col: str = "text", kinds=tuple(PATTERNS), out: str = "spans") -> DataFrame:
    """Add ``out``: confirmed spans by kind as listed, then start (code points, end exclusive)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs
    for k in kinds:
        p = PATTERNS[k]
        may = F.contains(text, F.lit(HINTS[k])) if k in HINTS else text.rlike(
            {"ip": r"[0-9]\.[0-9]", "card": "[0-9]", "iban": "[A-Z]{2}[0-9]{2}"}[k])
        d = d.withColumns({f"__m_{k}": F.when(may, F.regexp_extract_all(text, F.lit(p), F.lit(0))),
                           f"__g_{k}": F.when(may, F.split(text, p, -1))})
    # a second projection, so that matches and gaps are computed once
    for k in kinds:
        m, g = F.col(f"__m_{k}"), F.col(f"__g_{k}")
        steps = F.zip_with(F.slice(g, F.lit(1), F.size(m)), m, lambda a, b: F.length(a) + F.length(b))
        d = d.withColumn(f"__o_{k}", F.when(F.size(m) > 0, running_sums(steps)))
    parts = [_spans_of(k, F.col(f"__m_{k}"), F.col(f"__g_{k}"), F.col(f"__o_{k}")) for k in kinds]
    return d.withColumn(out, F.concat(*parts)).drop(*[f"__{c}_{k}" for c in "mgo" for k in kinds])


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_spans(docs).select("doc_id", "spans")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"),
                        count("iban").alias("n_iban"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("max_score"))
