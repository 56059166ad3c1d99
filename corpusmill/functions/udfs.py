"""The few scalar functions Spark has no built-in for, as Arrow-batched pandas UDFs.

Callers pass null for rows that need no Python work (ASCII text, valid UTF-8),
so Arrow ships only the rows that matter.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType


def _normalizer(form: str):
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize(form, x))
    return run


# Marked non-deterministic only to stop Catalyst from inlining the call into
# filters it pushes below a projection or exchange: the optimizer would
# otherwise evaluate the Python UDF twice (once for the filter, once for the
# output), the first time before the scan has been spread over the cluster.
nfc_udf = F.pandas_udf(_normalizer("NFC"), StringType()).asNondeterministic()
nfkc_udf = F.pandas_udf(_normalizer("NFKC"), StringType()).asNondeterministic()


@F.pandas_udf(StringType())
def lenient_utf8_decode(s: pd.Series) -> pd.Series:
    return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", errors="ignore"))


def _strict_json(x):
    import json
    if x is None:
        return None
    try:
        json.loads(x)
        return True
    except ValueError:
        return False


_RECORD = StructType().add("kind", StringType()).add("text_type", StringType()).add("text", StringType())


def _json_record(x):
    import json
    try:
        v = json.loads(x) if x is not None else None
    except (ValueError, RecursionError):
        v = None
    if isinstance(v, list):
        return "array", None, None
    if not isinstance(v, dict):
        return None, None, None
    if "text" not in v:
        return "object", None, None
    t = v["text"]
    if isinstance(t, str):
        return "object", "STRING", t.encode("utf-8", "replace").decode("utf-8")
    return "object", "VOID" if t is None else type(t).__name__.upper(), None


def _json_records(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_json_record(x) for x in s], columns=["kind", "text_type", "text"], dtype=object)


# Python's reading of lines that the variant parser refuses (NaN and Infinity members, repeated
# keys, values beyond its size limit); non-deterministic for the reason given at ``nfc_udf``
json_record = F.pandas_udf(_json_records, _RECORD).asNondeterministic()


@F.pandas_udf(BooleanType())
def json_strict_ok(s: pd.Series) -> pd.Series:
    """Python's ``json.loads`` verdict: Spark's parser accepts trailing content after
    the first value, Python does not.  Called only on rows that look suspicious."""
    return s.map(_strict_json)
