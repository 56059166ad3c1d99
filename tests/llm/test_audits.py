"""Filter audit, sharding and source divergence against plain Python, on corner cases and a whole table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import divergence, filter_audit, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, id string, n int"
LABELS = "doc_id long, quality int, toxic int, mask int"
WORDS = [f"w{i}" for i in range(60)] + ["Ärger", "ÉTÉ", "x_y", "日本", "LOUD", "q"]


def corpus(seed=3, n=160):
    rng = random.Random(seed)
    texts = [None, "", "", " \t\n\x0b\x0c\r ", "one", "ONE", "$", "A" * 40, "日本 " * 60, "a b " * 70, "w1 " * 70,
             " ".join(f"u{i}" for i in range(50)), " ".join(f"u{i}" for i in range(49)), "x" * 20000, "long " * 9000]
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 55, 90]))) for _ in range(n)]
    texts += ["same text again"] * 40 + rng.sample(texts, 20)
    rows = []
    for i, t in enumerate(texts):
        doc_id = None if i % 37 == 5 else i * 7 % 1000 if i % 11 else 4
        rows.append((doc_id, t, rng.choice(["en", "de", "", None]), "hot" if i % 3 == 0 else rng.choice([None, "", "b", "c"]),
                     1, "clash", "clash", i))
    rows += [rows[30], rows[30], rows[41]]
    rng.shuffle(rows)
    return rows


def plain_audit(rows, labels):
    lab = defaultdict(lambda: [0, 0])
    for i, q, t, *_ in labels:
        if i is not None:
            lab[i] = [max(lab[i][0], int(q == 1)), max(lab[i][1], int(t == 1))]
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    docs = []
    for r in rows:
        t = r[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = "".join(c for c, b in zip("ABCDE", [
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t) is not None, r[0] is not None and r[0] > first[t]]) if b)
        docs.append((r[3] or "", bad, *(lab[r[0]] if r[0] is not None else (0, 0))))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[1]]
                left = [d for d in left if c not in d[1]]
                total[c] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(c in d[1] for d in mine) - len(gone),
                                                   sum(d[1] == c for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_filter_audit(spark, parts):
    rows = corpus()
    labels = [(i, i % 2, int(i % 5 == 0), 9) for i in range(0, 900, 3)] + [(4, 0, 1, 9), (4, 1, 0, 9), (None, 1, 1, 9), (9, None, None, 9)]
    failed = filter_audit.failures(spark.createDataFrame(rows, SCHEMA).repartition(parts), spark.createDataFrame(labels, LABELS))
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in filter_audit.audit(failed).collect()}
    want = plain_audit(rows, labels)
    assert got == want
    values = {(r["part"], r["filter"]): r["shapley"] for r in filter_audit.shapley(failed).collect()}
    for (part, order, step), v in want.items():
        assert abs(values[part, order[step - 1]] - v[-1] / 120) < 1e-9
    worth = {r["coalition"]: r["removed"] for r in filter_audit.coalitions(failed).filter("part = 'hot'").collect()}
    assert len(worth) == 32 and worth[""] == 0 and worth["ABCDE"] == max(worth.values())
    assert abs(sum(v for (p, _), v in values.items() if p == "hot") - worth["ABCDE"]) < 1e-9  # efficiency


def test_filter_audit_empty(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(filter_audit.failures(docs, labels)).count() == 0
    one = spark.createDataFrame(corpus()[:30], SCHEMA)
    assert filter_audit.audit(filter_audit.failures(one, labels)).agg(F.sum("good_lost")).first()[0] == 0


def greedy(sizes, cap):
    n, room = 0, 0
    for s in sizes:
        if s > room:
            n, room = n + 1, cap
        room -= s
    return n


def check_shards(rows, got, shards):
    """Contract, atomic groups, order of the groups, and the smallest possible largest shard."""
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), hashlib.sha256((r[1] or "").encode()).digest())
                   for r in rows)
    assert Counter((r["id"], r["size"], r["crc"], bytes(r["digest"])) for r in got) == want
    bytes_of, shard_of = Counter(), {}
    slots = defaultdict(list)
    for r in got:
        d = bytes(r["digest"])
        bytes_of[d] += r["size"]
        assert shard_of.setdefault(d, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    total = sum(bytes_of.values())
    fair = -(-total // shards)
    order = sorted(bytes_of, key=lambda d: (-max(bytes_of[d] - fair, 0), d))
    assert [shard_of[d] for d in order] == sorted(shard_of.values())
    loads = Counter()
    for d, b in bytes_of.items():
        loads[shard_of[d]] += b
    sizes = [bytes_of[d] for d in order]
    best = next(c for c in range(max(sizes), total + 1) if greedy(sizes, c) <= shards) if total < 200_000 else None
    if best:
        assert max(loads.values()) == best
    return loads, max(sizes), fair


def test_sharding(spark):
    rng = random.Random(1)
    rows = corpus()
    small = [(i, "x" * rng.choice([0, 1, 5, 30, 400]) + str(rng.randint(0, 60)), "l", "s", 1, "p", "i", 1) for i in range(300)]
    hot = small + [(None, "hot text of some length", "l", "s", 1, "p", "i", 1)] * 200
    two = small[:40] + [(7, "y" * 900, "l", "s", 1, "p", "i", 1)] * 9 + [(8, "z" * 950, "l", "s", 1, "p", "i", 1)] * 9
    for data in (rows, small, hot, two, [(None, None, None, None, 1, "p", "i", 1)] * 5, rows[:3]):
        for shards in ((3, 8) if data is hot else (8,)):
            df = spark.createDataFrame(data, SCHEMA).repartition(5)
            got = sharding.shard_by_bytes(df, shards).collect()
            check_shards(data, got, shards)
    loads, _, _ = check_shards(hot, sharding.shard_by_bytes(spark.createDataFrame(hot, SCHEMA), 4).collect(), 4)
    assert sharding.shard_by_bytes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sharding_whole_table(spark, tmp_path):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    rows = [(r["doc_id"], r["text"]) for r in table]
    out = sharding.op12_sharding(spark, "/root/testdata/sf0.01")
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = sharding.shard_by_bytes(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    loads, largest, fair = check_shards(rows, got, 8)
    assert max(loads.values()) <= max(fair, largest) + largest and len(loads) == 8
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in out.collect()}
    assert again == {(r["id"], r["shard"], r["slot"]) for r in got}


def plain_divergence(rows, min_docs, top):
    uses, df, groups = Counter(), Counter(), set()
    for r in rows:
        t, lang, source = (r[k] or "" for k in (1, 2, 3))
        groups.add((lang, source))
        terms = ["".join(c.lower() if c < "\x80" else c for c in w)
                 for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]
        for w in terms:
            uses[lang, source, w] += 1
        for w in set(terms):
            df[lang, w] += 1
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= min_docs:
            kept[lang].append(w)
    out = set()

    def shares(lang, count):
        total = sum(count(w) for w in kept[lang])
        return {w: 1 + (1_000_000_000 * (count(w) + 1)) // (total + len(kept[lang])) for w in kept[lang]}
    for lang, source in groups:
        sources = [s for x, s in groups if x == lang]
        p = shares(lang, lambda w: uses[lang, source, w])
        best = []
        for other in sources:
            if other != source:
                q = shares(lang, lambda w: uses[lang, other, w])
                best.append((-sum((p[w] - q[w]) ** 2 // q[w] for w in p), other.encode()))
        out |= {(lang, source, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(sorted(best), 1)}
        q = shares(lang, lambda w: sum(uses[lang, s, w] for s in sources))
        best = sorted((-((p[w] - q[w]) ** 2 // q[w]), w.encode()) for w in p if uses[lang, source, w] and p[w] > q[w])
        out |= {(lang, source, "term", w.decode(), -v, k) for k, (v, w) in enumerate(best[:top], 1)}
    return out


@pytest.mark.parametrize("side,fan", [(64, 8), (2, 2)])
def test_divergence(spark, side, fan):
    rows = corpus(n=60)
    rows += [(i, "solo words here " * 3, "fr", "only", 1, "p", "i", 1) for i in range(4)]
    rows += [(i, f"nothing{i}", "it", s, 1, "p", "i", 1) for i, s in enumerate("abc")]
    rows += [(i, " ".join(f"t{chr(97 + i)}{chr(97 + j)}" for j in range(i % 5, 26, 1 + i % 3)) + " shared tally", "es", f"s{i % 9}", 1, "p", "i", 1)
             for i in range(26)]
    got = {tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, SCHEMA).repartition(4), top=7, side=side, fan=fan).collect()}
    want = plain_divergence(rows, 3, 7)
    assert got == want


def test_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    for text in ("", "a", "abcdefgh ijk", "  1 2 ", "aé日本 x" * 9, "a" * 40):
        data = text.encode()
        pieces = list(divergence._pieces(data))
        assert b"".join(pieces) == data
        assert [t for x in pieces for t in divergence.TERM.findall(x)] == divergence.TERM.findall(data)


def test_divergence_empty(spark):
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counting_holds_a_bounded_table(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "TABLE_BYTES", 20_000)
    texts = [" ".join(f"t{a}{b}".translate(str.maketrans("0123456789", "abcdefghij")) for b in range(200)) for a in range(50)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 50, "source": ["s"] * 50, "text": texts})
    out = list(divergence._count_batches([batch]))
    assert len(out) >= 50 and max(b.num_rows for b in out) <= 401
    assert sum(b.column("df")[0].as_py() for b in out) == 50 and all(b.column("term")[0].as_py() is None for b in out)
