"""Exactness of many merges a round: against one merge at a time, over words, bounds and repeated strings."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.operators import bpe
from test_bpe import reference_bpe


def blocks(words):
    """The words in blocks of about 40 symbols."""
    out, part = [], []
    for w, c in words.items():
        part.append((w, c))
        if sum(len(x) for x, _ in part) > 40:
            out.append(part)
            part = []
    out += [part] if part else []
    return [bpe._block(np.array([s for w, _ in p for s in w]), np.array([len(w) for w, _ in p]), np.array([c for _, c in p])) for p in out]


def words_of(batches):
    out = Counter()
    for flat, lens, weights in bpe._blocks(batches):
        at = 0
        for n, c in zip(lens.tolist(), weights.tolist()):
            out[tuple(flat[at:at + n].tolist())] += c
            at += n
    return out


def rows(batches):
    out = Counter()
    for b in batches:
        for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            out[k] += n
    return out


def train_in_rounds(counts, num_merges, max_live):
    """The rounds of the trainer over some blocks, with at most ``max_live`` live pairs."""
    names = sorted({ch for w in counts for ch in "▁" + w})
    ids = {s: i for i, s in enumerate(names)}
    words = Counter({tuple(ids[c] for c in "▁" + w): n for w, n in counts.items()})
    found, rounds = [], 0
    while len(found) < num_merges:
        pairs = rows(bpe._count_pairs(blocks(words)))
        if not pairs:
            break
        order = sorted(pairs.values(), reverse=True)
        floor = 1 if len(order) <= max_live else order[max_live] + 1
        live = np.array(sorted(k for k, n in pairs.items() if n >= floor), dtype=np.int64)
        limit = num_merges - len(found)
        rounds += 1
        if not len(live):  # all tie
            live = np.array([min((k for k in pairs if pairs[k] == order[0]), key=lambda k: (names[k >> 32], names[k & 0xFFFFFFFF]))])
            floor, limit = order[0], 1
        chains = rows(bpe._cut_chains(blocks(words), live))
        flat = np.frombuffer(b"".join(chains), dtype="<i4")
        lens = np.array([len(t) // 4 for t in chains])
        sim = bpe._Chains(flat, lens, np.array(list(chains.values())), names, floor)
        merges = sim.merges(limit)
        assert merges
        found += [(names[l], names[r], c) for l, r, m, c in merges]
        result = {t: (new := sim.sym[e - n:e])[new >= 0].astype(np.int32) for t, e, n in zip(chains, np.cumsum(lens), lens)}
        before = words
        merged = np.unique([l << 32 | r for l, r, *_ in merges])
        words = words_of(bpe._apply(blocks(words), live, merged, result))
        table = bpe.merge_table(m[:3] for m in merges)
        want = Counter()
        for w, c in before.items():
            want[tuple(bpe.merge_in_order(w, table))] += c
        assert words == Counter({w: c for w, c in want.items() if len(w) > 1})
    return found, rounds


@pytest.mark.parametrize("seed", range(24))
def test_rounds_equal_one_merge_at_a_time(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 4 == 0 else "abc" if seed % 4 == 1 else "abcdefgh"
    words = Counter()
    for _ in range(rng.choice([3, 30, 120])):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, rng.choice([3, 9, 25]))))
        words[w] += rng.choice([1, 1, 2, 5, 40])
    want = reference_bpe(words, 150)
    for max_live in (1, 3, 7, 10_000):
        got, rounds = train_in_rounds(words, 150, max_live)
        assert got == want, max_live
    assert rounds <= 2 or len(want) < 3 or any(n == 0 for *_, n in want) or rounds < len(want)


def test_one_round_does_many_merges():
    rng = random.Random(9)
    syll = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt"]
    words = Counter("".join(rng.choice(syll) for _ in range(rng.randint(1, 5))) for _ in range(3000))
    got, rounds = train_in_rounds(words, 400, 10_000)
    assert len(got) == 400 and rounds == 1
    got2, rounds2 = train_in_rounds(words, 400, 60)
    assert got2 == got and rounds2 < 100


def test_distributed_training_equals_one_merge_at_a_time(spark):
    rng = random.Random(4)
    words = Counter("".join(rng.choice("aabcde") for _ in range(rng.randint(1, 12))) for _ in range(300))
    wf = spark.createDataFrame(list(words.items()), "word string, count long").repartition(5)
    want = reference_bpe(words, 60)
    for bounds in ({}, {"max_symbols": 400}, {"max_pairs": 12}):
        got = [(r.left, r.right, r["count"]) for r in bpe.train_bpe(wf, 60, **bounds).orderBy("rank").collect()]
        assert got == want, bounds


def test_merge_in_order_is_sequential_application():
    rng = random.Random(2)
    for _ in range(300):
        merges = []
        strings = ["a", "b", "c"]
        for _ in range(rng.randint(1, 8)):
            l, r = rng.choice(strings), rng.choice(strings)
            merges.append((l, r, l + r))
            strings.append(l + r)
        word = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        want = list(word)
        for l, r, m in merges:
            out = []
            while want:
                if want[:2] == [l, r]:
                    out.append(m)
                    want = want[2:]
                else:
                    out.append(want.pop(0))
            want = out
        assert bpe.merge_in_order(word, bpe.merge_table(merges)) == want
    assert len(bpe.merge_in_order(["a"] * 50_000, bpe.merge_table([("a", "a", "aa"), ("aa", "aa", "aaaa")]))) == 12_500


def test_byte_pieces_round_trip(spark):
    lines = spark.createDataFrame([(0, "low lower  <0x41> ×😀 日本語"), (1, ""), (2, "zzz <0x41> <0x41> <0x41> <unk> <s>"),
                                   (3, "é naïve Ω")], "k long, line string")
    from corpusmill.operators.vocab import word_table
    train = spark.createDataFrame([("low", 90), ("lower", 80), ("<0x41>", 70), ("naïve", 1), ("zzz", 9)], "word string, count long")
    symbols = bpe.alphabet(train, coverage=0.999)
    assert "ï" not in symbols and "l" in symbols and "▁" in symbols
    merges = bpe.train_bpe(train, 40, symbols=symbols)
    vocab = bpe.bpe_vocab(train, merges, symbols=symbols, byte_pieces=True)
    assert vocab.count() == vocab.select("id").distinct().count()
    toks = bpe.encode_subword(lines, merges, vocab, ["k"], byte_pieces=True)
    ids = {r.k: r.ids for r in toks.collect()}
    assert ids[1] == [] and all(i > 3 for x in ids.values() for i in x)
    dec = {r.k: r.text for r in bpe.decode_subword(toks, vocab, ["k"]).collect()}
    assert dec == {r.k: " ".join(r.line.split()) for r in lines.collect()}
    plain = bpe.encode_subword(lines, merges, vocab.filter("id < 4 or id > 259"), ["k"])
    assert 3 in {i for r in plain.collect() for i in r.ids}
    broken = spark.createDataFrame([(0, [4 + 0xE6, 4 + 0x97, 4 + 0x41])], "k long, ids array<int>")
    assert bpe.decode_subword(broken, vocab, ["k"]).first().text == "A"
    assert word_table(lines).count()


def test_rows_of_blocks_are_small_and_lose_no_word():
    """A task gets up to 10,000 rows at once, so a row must be small whatever the number of words."""
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcdef", k=rng.randint(2, 12))) for _ in range(20_000)})
    batch = pa.RecordBatch.from_pydict({"word": words, "count": [1 + len(w) for w in words]})
    ids = {c: i for i, c in enumerate("▁abcdef")}
    sent = list(bpe._to_blocks([batch], ids))
    assert len(sent) > 10 and max(b.nbytes for b in sent) < 64_000
    want = Counter({tuple(ids[c] for c in "▁" + w): 1 + len(w) for w in words})
    assert words_of(sent) == want
    whole = [np.concatenate(x) for x in zip(*bpe._blocks(sent))]
    again = list(bpe._in_blocks(*whole))
    assert max(b.nbytes for b in again) < 64_000 and words_of(again) == want
