"""Personal data, mixing and exact dedup against brute force, on corner cases and whole tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import exact_dedup, mixing, pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def base_spans(text):
    out = []
    for k, p in PLAIN.items():
        for m in re.finditer(p, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            if (k == "ip" and any(int(x) > 255 for x in v.split("."))) or (
                    k == "card" and not (16 <= len(d) <= 19 and luhn(d))) or (k == "phone" and not 8 <= len(d) <= 15):
                continue
            out.append((k, m.start(), m.end()))
    return out


NASTY = [
    None, "", "a@b", "a@b.c", "x a@b.co_x@y.z", "1.2.3.4.5.6.7.8", "999.1.1.1 0255.0.0.1 1.1.1.256", "..@a.b@c.d.",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "é😀 4111111111111111 ü a@b.cd 😀", "+49 (30) 1234-5678 +1 2",
    "+1 ((((((((((", "+1234567890123456", "1 2 3 4", "9" * 5000, "a" * 50000, "a." * 20000 + "@", "x@" + "a." * 9000 + "b",
    "IBAN DE89 3704 0044 0532 0130 00 x", "DE89370400440532013000", "DE88370400440532013000", "mail: q@r.st",
    " ".join(f"u{i}@h{i}.org 10.0.{i % 300}.1" for i in range(700)), "a@b.c" * 300, "1.1.1.1" * 50, "+" * 3000,
]


def test_pii_against_plain_patterns(spark):
    rng = random.Random(5)
    texts = NASTY + ["".join(rng.choice("a1.@+- 45(9") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t, "l", None, 1) for i, t in enumerate(texts)], SCHEMA).repartition(8)
    got = {r["doc_id"]: r["spans"] for r in pii.find_spans(df).select("doc_id", "spans").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own = [(s["kind"], s["start"], s["end"]) for s in got[i]]
        assert [s for s in own if s[0] != "iban"] == base_spans(t), t
        assert all(t[s["start"]:s["end"]] == s["value"] for s in got[i])
    assert [s["kind"] for s in got[19]].count("iban") == 1
    assert [s["kind"] for s in got[20]].count("iban") == 1 and not [s for s in got[21] if s["kind"] == "iban"]
    assert got[22][0]["score"] > got[13 - 10][0]["score"]  # a context word raises the score


def test_pii_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = pii.op1_pii(spark, d).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert len(rows) == len(text)
    for r in rows:
        b = base_spans(text[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x[0] == k for x in b) for k in PLAIN]


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        ws = sum(w[s] for s in names if s not in full)
        t = {s: 2 * sizes[s] if s in full else left * w[s] / ws for s in names}
        over = {s for s in names if s not in full and t[s] > 2 * sizes[s]}
        if not over:
            return t
        full |= over


def mix_rows(rng, n=400):
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 40]))), "l",
             rng.choice(["a", "a", "a", "a", "b", "é", "Z", None, ""]), 0) for i in range(n)]
    return rows + [(7, None, "l", "b", 0), (None, "x y z", "l", "b", 0), (None, "x y z", "l", "b", 0),
                   (3, "  a b \t c ", None, "c", 0)]


def test_mix_targets_and_take(spark):
    rows = mix_rows(random.Random(2))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("clash")).withColumn("target", F.lit(1))
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(re.findall(mixing.WORD, r[1] or ""))
    want = brute_targets(sizes)
    for s, t in want.items():
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - t) < 1e-6 for r in own)
        assert abs(sum(r["taken"] for r in own) - t) <= 0.51
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    again = mixing.mix(df.repartition(3)).collect()
    key = lambda r: (str(r["id"]), r["key"], r["taken"], str(r["position"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    placed = [r["position"] for r in got if r["taken"]]
    assert placed == sorted(placed) and all(0 <= p < 1 for p in placed)


def test_mix_schedule_is_the_integral(spark):
    knots = ((0.0, 1.0), (0.25, 3.0), (1.0, 0.0))
    area = lambda t: t + 4 * t * t if t <= .25 else .5 + 3 * (t - .25) - 2 * (t - .25) ** 2
    df = spark.range(0, 50).select((F.col("id") / 50).alias("y"))
    for r in df.select("y", mixing.demand_inverse(F.col("y"), F.lit(0), [knots]).alias("t")).collect():
        assert abs(area(r["t"]) / area(1.0) - r["y"]) < 1e-9


def test_mixed_documents(spark):
    rows = mix_rows(random.Random(3))
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = out.collect()
    words = lambda t: len(re.findall(mixing.WORD, t or ""))
    plan = mixing.mix(df).collect()
    assert sum(words(r["text"]) for r in got) == sum(r["taken"] for r in plan)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1] or "")
    assert all(any(t.startswith(r["text"]) for t in texts[r["doc_id"]]) for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None, "x", "s", 0), (2, "", "x", "s", 0), (None, "", "x", "s", 0),
                                       (5, "é", "x", "s", 0), (5, "é", "x", "s", 0), (4, "é", "y", "s", 0),
                                       (6, "é", "x", "s", 0), (None, "n", "x", "s", 0), (None, "n", "x", "s", 0)]
                                  + [(100 + i, "hot", "x", "s", 0) for i in range(300)]])
def test_exact_dedup(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit(1)).withColumn("run", F.lit(2))
    got = exact_dedup.tree_merge_dedup(df, runs=16, fan_in=4).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    want = sorted((str(i), str(max([x for x in ids if x is not None], default=None)), len(ids),
                   hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], bytes(r["digest"]).hex()) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(groups)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(df).count() == 0 and mixing.mixed_documents(df).count() == 0
    assert pii.find_spans(df).count() == 0
