"""BPE training and subword round trip against a tiny independent implementation."""

from collections import Counter

from corpusmill.operators import bpe, tokenize
from corpusmill.operators.vocab import WORD_START


def reference_bpe(word_counts, num_merges):
    words = {tuple([WORD_START] + list(w)): c for w, c in word_counts.items()}
    merges = []
    for _ in range(num_merges):
        pairs = Counter()
        for sym, c in words.items():
            for a, b in zip(sym, sym[1:]):
                pairs[(a, b)] += c
        if not pairs:
            break
        (a, b), n = min(pairs.items(), key=lambda kv: (-kv[1], kv[0]))
        merges.append((a, b, n))
        new = {}
        for sym, c in words.items():
            out, i = [], 0
            while i < len(sym):
                if i < len(sym) - 1 and sym[i] == a and sym[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(sym[i])
                    i += 1
            new[tuple(out)] = new.get(tuple(out), 0) + c
        words = new
    return merges


def test_bpe_matches_reference(spark):
    text = "low lower lowest newer wider new news aaa aaaa banana bandana low low newer"
    counts = Counter(text.split())
    wf = spark.createDataFrame(list(counts.items()), "word string, count long")
    got = [(r.left, r.right, r["count"]) for r in bpe.train_bpe(wf, 12, materialize_every=4)
           .orderBy("rank").collect()]
    assert got == reference_bpe(counts, 12)


def test_subword_roundtrip(spark):
    lines = spark.createDataFrame([(0, 0, "low lower  newest"), (0, 1, ""), (1, 0, "zzz banana")],
                                  "doc_id long, line_no long, line string")
    from corpusmill.operators.vocab import word_table
    wf = word_table(lines, "line")
    merges = bpe.train_bpe(wf, 6)
    vocab = bpe.bpe_vocab(wf, merges)
    toks = bpe.encode_subword(lines, merges, vocab, ["doc_id", "line_no"])
    dec = {(r.doc_id, r.line_no): r.text for r in bpe.decode_subword(toks, vocab, ["doc_id", "line_no"]).collect()}
    assert dec == {(0, 0): "low lower newest", (0, 1): "", (1, 0): "zzz banana"}
    ids = {(r.doc_id, r.line_no): r.ids for r in toks.collect()}
    assert ids[(0, 1)] == [] and all(i > 3 for i in ids[(0, 0)])


def test_no_word_is_a_row_of_a_shuffle(spark):
    from corpusmill.operators.vocab import word_table
    lines = spark.createDataFrame([(k, f"the low tower {k} the café") for k in range(50)], "k long, line string")
    wf = word_table(lines, "line")
    merges = bpe.train_bpe(wf, 6)
    vocab = bpe.bpe_vocab(wf, merges)
    toks = bpe.encode_subword(lines, merges, vocab, ["k"])
    text = bpe.decode_subword(toks, vocab, ["k"], keys_differ=True)
    for df in (toks, text):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Generate" not in plan
    assert {r.k: r.text for r in text.collect()} == {k: f"the low tower {k} the café" for k in range(50)}


def test_rows_with_one_key_make_one_row_place_by_place(spark):
    merges = spark.createDataFrame([], "rank int, left string, right string, piece string, count long")
    vocab = spark.createDataFrame([(WORD_START, 4), ("a", 5), ("b", 6), ("c", 7)], "piece string, id int")
    lines = spark.createDataFrame([(1, "c a"), (1, "b"), (None, "a"), (None, None), (2, None), (2, ""), (3, "c")],
                                  "k long, line string")
    toks = bpe.encode_subword(lines, merges, vocab, ["k"])
    assert {r.k: r.ids for r in toks.collect()} == {1: [4, 6, 4, 7, 4, 5], None: [4, 5], 2: [], 3: [4, 7]}
    rows = spark.createDataFrame([(1, [4, 7, 5]), (1, [2, 6, None, 99, 5]), (2, None), (2, []), (None, [6])], "k long, ids array<int>")
    text = bpe.decode_subword(rows, vocab, ["k"])
    assert {r.k: r.text for r in text.collect()} == {1: _places(), 2: "", None: "b"}


def _places():
    # kept places: [▁ c a] and [b (none) a]; of one place in order of the bytes
    places = [sorted([WORD_START.encode(), b"b"]), [b"c"], [b"a", b"a"]]
    return b"".join(p for place in places for p in place).decode().replace(WORD_START, " ").strip()


def test_remembered_words_of_two_generations():
    asked = []
    known = tokenize.Remembered(lambda w: asked.append(w) or [len(w)], most=60)
    assert [known[w] for w in ("a", "bb", "a", "ccc", "a", "dddd", "a", "bb")] == [[1], [2], [1], [3], [1], [4], [1], [2]]
    assert len(known) <= 4 and asked.count("a") == 1
