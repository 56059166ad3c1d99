"""Jaccard join, suffix dedup, codec, token counts and nearest neighbours against brute force."""

import collections
import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import jaccard_join, nearest, piece_codec, suffix_dedup, token_counts

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, node long, label string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, 7, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# --- Jaccard join

def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(texts, ids):
    sets = [shingles(t) for t in texts]
    by = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in {(a, b) for c in by.values() for k, a in enumerate(c) for b in c[k + 1:]}:
        a, b = sets[x[0]], sets[x[1]]
        if 100 * len(a & b) >= 80 * len(a | b):
            root[find(x[0])] = find(x[1])
    low = collections.defaultdict(list)
    for i in range(len(sets)):
        low[find(i)].append(ids[i])
    return sorted((str(ids[i]), len(sets[i]), str(min((x for x in low[find(i)] if x is not None), default=None)) if sets[i]
                   else str(ids[i])) for i in range(len(sets)))


def near_texts(rng, groups=12, size=9):
    texts = [None, "", " \t\n", "one", "One", "a b c d", "A B C D", "a b c d e", "ä Ö", "Ä Ö"]
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([8, 30, 120]))]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 40))):
                t[rng.randrange(len(t))] = f"x{rng.randint(0, 50)}"
            texts.append(" ".join(t))
    line = " ".join(f"common{i}" for i in range(9))
    return texts + [line + " " + " ".join(f"u{rng.randint(0, 9999)}" for _ in range(20)) for _ in range(80)]


@pytest.mark.parametrize("leaf", [2, 48])
def test_jaccard_components(spark, leaf):
    texts = near_texts(random.Random(leaf))
    ids = [i * 7 % 1009 for i in range(len(texts))]
    ids[20] = None
    ids[31] = ids[30]  # rows that repeat an id
    got = jaccard_join.jaccard_components(frame(spark, texts, ids), leaf=leaf).collect()
    assert sorted((str(r["id"]), r["n_shingles"], str(r["component_id"])) for r in got) == components(texts, ids)


def test_jaccard_crowded_region(spark):
    """Many near copies of one text: more nodes in a region than are compared one by one."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:k] + [f"x{rng.random()}"] + base[k + 1:]) for k in rng.choices(range(5, 95), k=150)]
    ids = list(range(len(texts)))
    got = jaccard_join.jaccard_components(frame(spark, texts), leaf=8).collect()
    assert sorted((str(r["id"]), r["n_shingles"], str(r["component_id"])) for r in got) == components(texts, ids)


def test_jaccard_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = jaccard_join.op4_jaccard_join(spark, SF).collect()
    want = components([r["text"] for r in rows], [r["doc_id"] for r in rows])
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want


# --- suffix dedup

def removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[s:s + length] for r in raw for s in range(len(r) - length + 1))
    out = []
    for r in raw:
        m = np.zeros(len(r) + 1, np.int32)
        for s in range(len(r) - length + 1):
            if seen[r[s:s + length]] > 1:
                m[s] += 1
                m[s + length] -= 1
        c = np.cumsum(m)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], c.astype(int)])) == 1).sum())
        out.append((len(r), int(c.sum()), runs, hashlib.sha256(np.frombuffer(r, np.uint8)[~c].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeated_strings(spark, hot):
    rng = random.Random(4)
    base = "".join(rng.choice("abc é") for _ in range(3000))
    texts = ["a" * 700, "a" * 199, "", None, "zz" * 300, "q" * 200, "q" * 200, base, base, "ab" * 5000]
    for _ in range(120):
        a = rng.randint(0, 2500)
        x = base[a:a + rng.choice([150, 230, 420, 900])]
        if rng.random() < .5:
            x = x[:100] + rng.choice("XYZ") + x[101:]
        texts.append("".join(rng.choice("defg") for _ in range(rng.randint(0, 300))) + x + "tail" * rng.randint(0, 80))
    ids = [i % 90 if i % 11 else None for i in range(len(texts))]
    texts.append(texts[12])
    ids.append(ids[12])
    df = frame(spark, texts, ids).withColumnRenamed("node", "digest")
    found = suffix_dedup.repeated_spans(df, hot=hot)
    got = suffix_dedup._cut(found, 200, {"k": "string"}, lambda b: (hashlib.sha256(b).hexdigest(),)).collect()
    assert sorted((str(r["id"]), *list(r)[1:]) for r in got) == sorted((str(i), *r) for i, r in zip(ids, removed(texts, 200)))


def test_repeated_strings_of_one_passage(spark):
    """Many different texts around one passage shorter than a window, some of which do share windows: the classes of its anchor
    are divided into single windows, whose runs cross the boundaries of partitions."""
    rng = random.Random(9)
    core = "".join(rng.choice("uvwxyz") for _ in range(190))
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    texts = [word(rng.randint(0, 60)) + core + word(rng.randint(0, 60)) for _ in range(260)]
    tails = ["Q" * 9 + word(2) for _ in range(4)]
    texts += [word(rng.randint(1, 30)) + rng.choice("mn") + core + rng.choice(tails) + word(5) for _ in range(120)]
    texts += [texts[3], core, core + core]
    df = frame(spark, texts)
    found = suffix_dedup.repeated_spans(df, hot=20)
    got = suffix_dedup._cut(found, 200, {"k": "string"}, lambda b: (hashlib.sha256(b).hexdigest(),)).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, *r) for i, r in enumerate(removed(texts, 200)))


def test_window_runs_cross_partitions(spark):
    rng = random.Random(2)
    rows = [(bytes([rng.randrange(60)]), rng.randrange(4), bytes([rng.choice([1, 1, 1, 2, 3, rng.randrange(4, 250)])])) for _ in range(300)]
    rows = [(d, s, w) for (d, s), w in {(d, s): w for d, s, w in rows}.items()] * 2  # a place is given twice, but is one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "digest binary, start long, window binary")
        got = {(bytes(r["digest"]), r["start"], r["stop"]) for r in suffix_dedup._window_spans(df, 5).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    seen = collections.Counter(w for _, _, w in set(rows))
    assert got == {(d, s, s + 5) for d, s, w in rows if seen[w] > 1}


def test_repeated_strings_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = suffix_dedup.op7_suffix_dedup(spark, SF).collect()
    want = sorted((r["doc_id"], *x) for r, x in zip(rows, removed([r["text"] for r in rows], 200)))
    assert sorted(tuple(r) for r in got) == want


def test_multikey_order():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    group = np.sort(rng.integers(0, 20, 500))
    order = suffix_dedup.multikey_order(group, keys)
    rows = [(int(group[i]), *keys[i].tolist()) for i in order]
    assert rows == sorted(rows)


# --- SentencePiece

def test_codec_is_the_library():
    model = piece_codec.PieceModel(PIECES)
    rng = random.Random(1)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "▁", "é", "😀", "\0", "1", "\t", "ß", "中", "</s>", "<0x0A>", "x" * 60, "\r"]
    texts = ["", " ", "\n", "▁", "a" * 3000, "abc" * 9000] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    for k in range(0, len(texts), 40):
        part = texts[k:k + 40]
        for t, packed in zip(part, model.encode_many(part)):
            ids = model.lib.encode(t)
            assert struct.pack(f"<{len(ids)}I", *ids) == packed, t
    for t in ("▁hello", "▁▁▁x", "abcabc"):  # the heap agrees with the matrix
        ids = model.merge(t)
        assert model.merge_many([t])[0] == struct.pack(f"<{len(ids)}I", *ids)


def test_codec_whole_table(spark):
    lib = piece_codec.PieceModel(PIECES).lib
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = piece_codec.op6_sentencepiece(spark, SF).collect()
    assert len(got) == len(text)
    for r in got:
        ids = lib.encode(text[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_codec_columns_and_nulls(spark):
    df = frame(spark, [None, "", "hi there"], [None, 1, 1]).withColumn("ids", F.lit("clash"))
    got = piece_codec.encode(df, PIECES).collect()
    assert sorted(r["decoded"] for r in got) == ["", "", "hi there"]
    assert sorted(len(r["ids"]) // 4 for r in got)[:2] == [2, 2]
    assert piece_codec.encode(df.limit(0), PIECES).count() == 0


# --- token counts

def counter():
    return token_counts.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_edits_against_full_counts():
    c, rng = counter(), random.Random(1)
    parts = ["a", "'", "s", "'re", " ", "  ", "\n", "1", "é", "😀", "!", "\t", "the", " don't", "ab cd", "   x"]
    make = lambda n: "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))
    for k in range(1500):
        doc = token_counts.Document(make(900 if k % 50 == 0 else 30), c)
        for _ in range(6):
            a = rng.randint(-2, len(doc.text) + 2)
            b, new = a + rng.choice([0, 0, 1, 3, 20, 500]), make(rng.choice([0, 1, 4, 40]))
            s = min(max(a, 0), len(doc.text))
            want = doc.text[:s] + new + doc.text[min(max(b, s), len(doc.text)):]
            doc.edit(a, b, new)
            whole = token_counts.Document(want, c)
            assert doc.text == want and doc.ends == whole.ends
            assert doc.tree.total == whole.tree.total == len(c.lib.encode_ordinary(want))


def test_edits_touch_little():
    c = counter()
    doc = token_counts.Document("some words in a row " * 5000, c)
    assert doc.edit(50_000, 50_004, "xyz") <= 5


def test_count_edits(spark):
    docs = frame(spark, [None, "", "one two three", "same", "same"], [0, 1, 2, 3, 3]).withColumn("start", F.lit(1))
    edits = spark.createDataFrame([(2, 2, 0, 3, "four"), (2, 1, 0, 0, "zero "), (9, 1, 0, 0, "x"), (3, 1, None, None, None),
                                   (0, 1, 5, 9, "new"), (None, 1, 0, 0, "x")],
                                  "doc_id long, seq int, start int, end int, new string")
    got = token_counts.count_edits(docs, edits, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    c = counter()
    n = lambda t: len(c.lib.encode_ordinary(t))
    assert sorted((r["id"], r["n_tokens"], r["n_edits"], r["n_tokens_after"]) for r in got) == [
        (0, 0, 1, n("new")), (1, 0, 0, 0), (2, n("one two three"), 2, n("foro one two three".replace("foro", "fouro"))),
        (3, n("same"), 1, n("same")), (3, n("same"), 1, n("same"))]


def test_token_counts_whole_table(spark):
    c = counter()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text", token_counts.derived_edits(F.col("text"), F.col("doc_id")).alias("e")).collect()
    want = {}
    for r in rows:
        t = r["text"] or ""
        for e in r["e"]:
            s = min(max(e["start"], 0), len(t))
            t = t[:s] + e["new"] + t[min(max(e["end"], s), len(t)):]
        want[r["doc_id"]] = (len(c.lib.encode_ordinary(r["text"] or "")), len(c.lib.encode_ordinary(t)))
    got = token_counts.op8_token_counts(spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["n_tokens_after"]) for r in got} == want


# --- nearest neighbours

def brute_nearest(rows, queries, k):
    ok = {i: v for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q in queries:
        if q in ok:
            near = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return out


def test_nearest_corner_cases(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(120)]  # a hot vector
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2004, [float("nan")] * 6),
             (2005, [float("inf")] + [0.0] * 5), (2006, [1.0, 2.0]), (None, [1.0] * 6), (7, rows[7][1]), (2008, [1e-300] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", F.lit("clash"))
    queries = [i for i, _ in rows if i is not None and i % 20 == 0]
    got = nearest.nearest(df, df.filter("vec_id % 20 = 0"), k=20, candidate_block=50, query_block=10).collect()
    want = brute_nearest(rows, queries, 20)
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in got) == sorted(x[:3] for x in want)
    assert nearest.nearest(df.limit(0), df.limit(0)).count() == 0
    few = nearest.nearest(df.filter("vec_id < 5"), df.filter("vec_id = 0"), k=20).collect()
    assert len(few) == 4
