"""Toxicity, quality and the pipeline: held-out accuracy, corner cases, stages against brute force."""

import collections
import hashlib
import random
import struct
import zlib

import corpus_pipeline
import pyarrow as pa
import pytest

from corpusmill.llm import piece_codec, quality, toxicity
from corpusmill.sources.sinks import materialize
from test_text_ops import PIECES, components

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.mark.parametrize("query, label, cut, least", [(toxicity.op5_toxicity, "toxic", 0.7, 0.93), (quality.op10_quality, "quality", 0.5, 0.93)])
def test_held_out_accuracy(spark, query, label, cut, least):
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = query(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= cut) for r in got)
    tested = [r["predicted"] == truth[r["doc_id"]] for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert len(tested) > 50 and sum(tested) / len(tested) >= least


DOCS = "doc_id long, text string, score string, y int, label string"


@pytest.mark.parametrize("model", [toxicity, quality])
def test_model_corner_cases(spark, model):
    name = "toxic" if model is toxicity else "quality"
    rows = [(i, ("vile scum you fool " if i % 2 else "Calm words about the sea. ") * (1 + i % 5), "x", 9, "clash") for i in range(60)]
    rows += [(None, "vile scum", "x", 1, ""), (70, None, None, None, None), (71, "", "", 0, ""), (72, "vile " * 60_000, "", 0, ""),
             (3, rows[3][1], "x", 9, "clash")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(70, None), (None, 1)], f"doc_id long, {name} int")
    fitted = model.fit(docs, labels, name)
    got = model.score(docs, fitted, out="p").collect()
    assert len(got) == len(rows) and all(0 <= r["p"] <= 1 for r in got) and {r["y"] for r in got} == {9, 1, 0, None}
    by = collections.defaultdict(set)
    for r in got:
        by[r["text"] or ""].add(r["p"])
    assert all(len(v) == 1 for v in by.values())  # equal texts, equal scores
    if model is toxicity:
        assert min(r["p"] for r in got if r["doc_id"] is not None and r["doc_id"] < 60 and r["doc_id"] % 2) > max(
            r["p"] for r in got if r["doc_id"] is not None and r["doc_id"] < 60 and not r["doc_id"] % 2)
    assert model.score(docs.limit(0), fitted, out="p").count() == 0
    none = model.fit(docs, labels.limit(0), name)
    assert len({r["p"] for r in model.score(docs, none, out="p").collect()}) == 1


def test_misspellings_and_quotation():
    lexicon = toxicity.Lexicon({"scumbag": (4.0, 4.5, 5.0), "worthless": (4.0, 4.2, 4.4), "foo": (2.0, 2.0, 2.0)})
    assert lexicon.lookup("scumbag") == (("scumbag", 0),)
    assert lexicon.lookup("scunbag") == lexicon.lookup("scmubag") == (("scumbag", 1),)
    assert lexicon.lookup("wrthles") == (("worthless", 2),)
    assert lexicon.lookup("fop") == lexicon.lookup("harbour") == ()
    abuse, quote = lexicon.features("go away you scumbag"), lexicon.features('the report said "scumbag" was a word')
    assert abuse[0] > quote[0] and abuse[5] < quote[5]


def test_misspellings_of_all_terms():
    # 40 words with clearer evidence, and 40 of four letters, take no place from the others
    terms = {f"strong{chr(97 + i // 8)}{chr(97 + i % 8)}word": (6.0, 6.0, 6.0) for i in range(40)}
    terms |= {f"q{chr(97 + i // 8)}{chr(97 + i % 8)}z": (7.0, 7.0, 7.0) for i in range(40)}
    lexicon = toxicity.Lexicon(terms | {"worthless": (2.0, 2.0, 2.0), "moron": (2.0, 2.0, 2.0), "disgust*": (2.0, 2.0, 2.0)})
    for word, term, edits in [("wrthles", "worthless", 2), ("owrthless", "worthless", 1), ("worthlessly", "worthless", 2), ("mor0n", "moron", 1),
                              ("disgxsting", "disgust*", 1), ("dsigustingly", "disgust*", 1), ("xdisgusted", "disgust*", 1)]:
        assert (term, edits) in lexicon.lookup(word)
        assert any(lexicon.features(f"so {word} a thing"))
    assert lexicon.lookup("harbour") == ()


def test_misspellings_match_brute_force():
    def row(term, word):
        last = list(range(len(word) + 1))
        for i, c in enumerate(term):
            new = [i + 1]
            for j, w in enumerate(word):
                new.append(min(new[-1] + 1, last[j + 1] + 1, last[j] + (w != c)))
            last = new
        return last

    rng = random.Random(5)
    some = lambda a, b: "".join(rng.choice("abcé") for _ in range(rng.randint(a, b)))
    terms = {t: (1.0, 1.0, 1.0) for t in [*(some(3, 13) for _ in range(60)), *(some(3, 8) + "*" for _ in range(20))]}
    lexicon, found = toxicity.Lexicon(terms), 0
    for _ in range(400):
        word = list(rng.choice(sorted(terms)).rstrip("*"))
        for _ in range(rng.randint(0, 3)):
            i = rng.randint(0, len(word))
            word[i:i + rng.randint(0, 1)] = some(0, 1)
        word, want = "".join(word) + some(0, 2), {}
        for t in terms:
            d = row(t.rstrip("*"), word)
            d = min(d) if t.endswith("*") else d[-1]
            if 0 < d <= lexicon.edits(len(t.rstrip("*"))):
                want[t] = d
        assert lexicon.fuzzy(word) == want
        found += len(want)
    assert found > 100


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, columns, kept = [n for n, _ in corpus_pipeline.STAGES], docs.columns, {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = materialize(stage(spark, docs, SMALL), "test-stage")
        if name != names[-1]:
            assert set(columns) <= set(docs.columns)
    rows = {n: d.collect() for n, d in kept.items()}
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    left = {r["doc_id"] for r in rows[names[0]]}
    clean = [r["doc_id"] for r in rows[""] if truth.get(r["doc_id"]) == 0]
    assert len(left & set(clean)) >= 0.98 * len(clean)
    # exact copies: the largest id of each text stays
    best = {}
    for r in rows[names[0]]:
        best[r["text"] or ""] = max(best.get(r["text"] or "", -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows[names[1]]) == sorted(best.values())
    # near copies: one of each component stays
    before = rows[names[1]]
    heads = {c for _, n, c in components([r["text"] for r in before], [r["doc_id"] for r in before])}
    assert sorted(str(r["doc_id"]) for r in rows[names[2]]) == sorted(heads)
    assert {r["doc_id"] for r in rows[names[3]]} <= {r["doc_id"] for r in rows[names[2]]}
    lib = piece_codec.PieceModel(PIECES).lib
    want = []
    for r in rows[names[3]]:
        ids = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        want.append((r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()))
    as_rows = lambda rs: sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in rs)
    assert as_rows(rows[names[4]]) == sorted(want) == as_rows(corpus_pipeline.run(spark, SMALL).collect())


def test_words_around_a_hit():
    words = "a you b c d e f g h i j k l m n said o".split()
    flags = list(toxicity._around(words, toxicity.ADDRESS))
    assert flags == [not toxicity.ADDRESS.isdisjoint(words[max(0, i - toxicity.WINDOW):i + toxicity.WINDOW + 1]) for i in range(len(words))]
    lexicon = toxicity.Lexicon({"nasty": (2.0, 2.5, 3.0, 1.0)})
    # one plain hit, addressed; one quoted by a word of reporting far from it; two misspelled ones
    got = lexicon.features("you nasty " + "x " * 20 + "said nasty " + "x " * 20 + "nasti nasti")
    assert got[:3] == [2.5, 2.5, 2.5] and got[5:8] == [0.25, 0.5, 0.25] and got[10:] == [0.0, 0.0]
    assert lexicon.features("nasti " * 2)[10:] == [1.0, 1.0]


def test_words_looked_up_together():
    rng = random.Random(7)
    some = lambda a, b: "".join(rng.choice("abcé𝄞") for _ in range(rng.randint(a, b)))
    terms = {t: (1.0, 1.0, 1.0) for t in [*(some(3, 14) for _ in range(60)), *(some(3, 8) + "*" for _ in range(20)), "a" * 61, "b" * 70]}
    lexicon = toxicity.Lexicon(terms)
    words = {"", "a" * 60, "a" * 62, "a" * 63, "b" * 69, "b" * 71, "harbour"}
    for t in sorted(terms):
        for _ in range(8):
            word = list(t.rstrip("*"))
            for _ in range(rng.randint(0, 2)):
                i = rng.randint(0, len(word))
                word[i:i + rng.randint(0, 1)] = some(0, 1)
            words.add("".join(word) + some(0, 2))
    want = {w: lexicon.lookup(w) for w in words}
    assert sum(1 for hits in want.values() if any(d for _, d in hits)) > 200
    assert dict(lexicon.lookups(sorted(words))) == want
    # few automata at once, and few remembered words: the same hits, in bounded memory
    together, remembered = toxicity.TOGETHER, toxicity.REMEMBERED_BYTES
    toxicity.TOGETHER, toxicity.REMEMBERED_BYTES = 8, 4000
    try:
        for _ in range(2):
            assert lexicon.hits(words) == {w: hits for w, hits in want.items() if hits}
        assert len(lexicon.known) + len(lexicon.older) < len(words) / 2
    finally:
        toxicity.TOGETHER, toxicity.REMEMBERED_BYTES = together, remembered


def test_terms_are_counted_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(toxicity, "COUNTED", 50)
    monkeypatch.setattr(toxicity, "ROWS", 20)
    texts = [f"word{i}x other{i % 3} " + "vile " * (i % 5) for i in range(40)]
    read = []

    def batches():
        for i, text in enumerate(texts):
            read.append(i)
            yield pa.RecordBatch.from_pydict({"text": [text], "y": [i % 2]})

    sums = collections.defaultdict(lambda: [0] * 6)
    for n, b in enumerate(toxicity._counts(batches())):
        assert b.num_rows <= 20 and (n or len(read) < len(texts) / 2)  # terms go on before all texts are read
        for row in b.to_pylist():
            t = row.pop("term")
            sums[t] = [x + y for x, y in zip(sums[t], row.values())]
    want = collections.defaultdict(lambda: [0] * 6)
    for i, text in enumerate(texts):
        for t, n in toxicity.terms_of(text).items():
            for level in range(min(n, 3)):
                want[t][2 * level + i % 2] += 1
    assert sums == want and sums["vile"][4:] == [8, 8]
