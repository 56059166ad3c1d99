"""Toxicity by a learned lexicon, misspellings by Levenshtein automata, and context windows.

* Lexicon: words and word beginnings (stems) whose presence speaks for the label, learned from labelled rows;
  each term has a weight (log odds) for one, two, and three or more occurrences in a text.
  All terms are kept in tries, one for the terms of one size that have the same part.
* Misspellings: the Levenshtein automaton of a word (terms have one edit from 5 characters on, two from 9 on) is run over
  the tries of its own parts, as any misspelling must share an exact part with its term; so all lexicon words, and all
  stems as beginnings, within the distance are found.  Swaps of neighbours are looked up.  Their weight is learned apart
  from that of the term itself, so a term that common words resemble counts for little when misspelled.
  The new words of about a megabyte of texts run their automata together, those of one length step by step in arrays.
* Context: a window of words around each hit tells quotation (quote marks around it, words
  of reporting) from abuse (other hits, address in the second person) and scales the hit's weight.
* Score: logistic regression on the hits' weights and context, fitted to the same rows.

Labels are learned from at most ``max_train`` labelled rows that are not held out (the
bound on the classifier's sample); scoring reads every text as a whole.

Nulls and edge cases: a null or empty text has no hits and gets the score of that; rows with a null
label are not learned from; without rows of both labels nothing can be learned and every score is the share of
label 1 (0 without rows); a null id is held out; repeated rows are scored each; an empty table
gives an empty result.  Other columns are passed through.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import held_out, training_texts

MAX_TRAIN = 9_000
MAX_TERMS = 3_000
STEM = range(3, 9)
WINDOW = 6
LONGEST = 64
WIDEST = 62  # characters of a word whose automaton's states fit into 64 bits
REMEMBERED_BYTES = 24 << 20  # of words and their hits that a worker keeps
PIECE_BYTES = 1 << 20  # of texts whose new words are looked up together, and in an output batch
TOGETHER = 1 << 16  # automata, at most, that are run together
COUNTED = 60_000  # terms that a task counts before it passes them on
ROWS = 10_000  # of an Arrow batch
FACTOR = 0x9E3779B97F4A7C15  # odd, of the hashes of parts
WORDS = re.compile(r"\w+")
#: fixed word lists of the context window
ADDRESS = frozenset("you your yours u ur tu te toi ton vous votre du dich dir dein ihr euch eres usted ustedes".split())
REPORT = frozenset("said says say called calls call word words term quote quoted quotes wrote writes article report means meaning".split())
QUOTE = re.compile("[\"“”„«»‘’]")


class Lexicon:
    """Tries of terms; ``terms`` maps a term (words: as is, stems: with a final *) to three weights and, if learned, that
    of its misspellings."""

    def __init__(self, terms: dict[str, tuple]):
        self.terms = terms
        self.stems = frozenset(t[:-1] for t in terms if t.endswith("*"))
        #: by size of the terms and whether they are stems: place and tries of each of the k + 1 parts
        self.parts: dict[tuple[int, bool], list[tuple[int, int, dict]]] = {}
        self.plans: dict[int, list[tuple]] = {}
        self.swapped: dict[str, list[str]] = {}  # words, and beginnings of words for stems, with two neighbours swapped
        self.swapped_stems: dict[str, list[str]] = {}
        for t in terms:
            spelled = t.rstrip("*")
            k = self.edits(len(spelled))
            if not k:
                continue
            key = len(spelled), t != spelled
            if key not in self.parts:
                self.parts[key] = [(a, b, {}) for a, b in self._cuts(len(spelled), k)]
            for a, b, roots in self.parts[key]:
                node = roots.setdefault(spelled[a:b], {})
                for c in spelled:
                    node = node.setdefault(c, {})
                node[""] = t
            swapped = self.swapped if t == spelled else self.swapped_stems
            for i in range(len(spelled) - 1):
                if spelled[i] != spelled[i + 1]:
                    swapped.setdefault(spelled[:i] + spelled[i + 1] + spelled[i] + spelled[i + 2:], []).append(t)
        self.beginnings = self.stems | self.swapped_stems.keys()
        #: words with their hits, those met of late and those met before
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.size = 0
        self.longest = max((len(t) for t in terms), default=0)
        self._number_nodes()
        self.places: dict[int, list[tuple]] = {}

    def _number_nodes(self) -> None:
        """The tries as arrays: of each node its character, its children (which have numbers in a row), the term that ends there
        (-1: none) and whether it takes two edits; of each root the number of terms below it."""
        self.spelled = [t for t in self.terms if self.edits(len(t.rstrip("*")))]
        self.near = [None, [(t, 1) for t in self.spelled], [(t, 2) for t in self.spelled]]
        number = {t: i for i, t in enumerate(self.spelled)}
        nodes, char, first, count, ends, two = [], [], [], [], [], []
        self.root: dict[int, int] = {}
        self.below: list[int] = []
        for (size, _), parts in self.parts.items():
            for _, _, roots in parts:
                for trie in roots.values():
                    self.root[id(trie)] = len(nodes)
                    nodes.append(trie)
                    char.append(0)
                    two.append(self.edits(size) > 1)
        n_roots, i = len(nodes), 0
        self.below = [0] * n_roots
        of = list(range(n_roots))
        while i < len(nodes):
            first.append(len(nodes))
            end = nodes[i].get("")
            ends.append(-1 if end is None else number[end])
            self.below[of[i]] += end is not None
            for c, child in nodes[i].items():
                if c:
                    nodes.append(child)
                    char.append(ord(c))
                    two.append(two[i])
                    of.append(of[i])
            count.append(len(nodes) - first[i])
            i += 1
        self.char, self.first, self.count = np.array(char, np.uint32), np.array(first, np.int64), np.array(count, np.int64)
        self.ends, self.two = np.array(ends, np.int64), np.array(two, bool)
        self.below = np.array(self.below, np.int64)
        self.is_stem = np.array([t[-1] == "*" for t in self.spelled], bool)

    @staticmethod
    def edits(size: int) -> int:
        return 0 if size < 5 else 1 if size < 9 else 2

    @staticmethod
    def _cuts(size: int, k: int) -> list[tuple[int, int]]:
        n = k + 1
        at = [round(i * size / n) for i in range(n + 1)]
        return list(zip(at, at[1:]))

    def plan(self, n: int) -> list[tuple]:
        """For words of ``n`` characters: ``(from, to, tries, edits)`` of the places that may be an exact part of a term.

        At most k edits leave one of k + 1 parts as it is.  If it is the first, it is not moved; if it is the last, the edits all lie
        before it; the middle one of three is needed only with one edit before it and one after it at most.
        """
        out = []
        for (size, stem), parts in self.parts.items():
            k = self.edits(size)
            for extra in range(-k, k + 1):  # characters that the word, or its beginning that is like a stem, has more
                if not (size + extra <= n if stem else size + extra == n):
                    continue
                for i, (a, b, roots) in enumerate(parts):
                    moves = [0] if i == 0 else [extra] if i == k else [d for d in (-1, 0, 1) if abs(extra - d) <= 1]
                    out += [(a + d, b + d, roots, k) for d in moves if a + d >= 0 and b + d <= n]
        places = {(a, b, id(roots)): (a, b, roots, k) for a, b, roots, k in out}
        if n > LONGEST:  # such sizes are many and seldom
            return list(places.values())
        self.plans[n] = list(places.values())
        return self.plans[n]

    def fuzzy(self, word: str) -> dict[str, int]:
        """Terms within their distance of ``word`` (of a beginning of it, for stems): its automaton against the tries.

        Bit ``i`` of the automaton's state ``r[d]`` says that the first ``i`` characters of the word are
        reached with ``d`` edits at most; without any bit the walk does not enter the subtree below.
        """
        n = len(word)
        if n > LONGEST:
            # only stems can be like a beginning of it, and of that no more than a term and its edits
            return {t: d for t, d in self.fuzzy(word[:LONGEST]).items() if t[-1] == "*"} if self.longest + 2 <= LONGEST else self._fuzzy(word)
        return self._fuzzy(word)

    def _fuzzy(self, word: str) -> dict[str, int]:
        n, found = len(word), {}
        full, end = (2 << n) - 1, 1 << n
        masks: dict[str, int] = {}
        for a, b, roots, k in self.plans.get(n) or self.plan(n):
            root = roots.get(word[a:b])
            if root is None:
                continue
            if not masks:
                for i, c in enumerate(word):
                    masks[c] = masks.get(c, 0) | 1 << i
            todo = [(root, 1, 3, 7 & full if k > 1 else 0)]
            while todo:
                node, r0, r1, r2 = todo.pop()
                for c, child in node.items():
                    if c == "":
                        accept = full if child[-1] == "*" else end
                        if not r0 & accept:
                            if r1 & accept:
                                found[child] = 1
                            elif r2 & accept:
                                found[child] = 2
                        continue
                    m = masks.get(c, 0)
                    s0 = (r0 & m) << 1
                    s1 = ((r1 & m) << 1 | r0 | r0 << 1 | s0 << 1) & full
                    s2 = ((r2 & m) << 1 | r1 | r1 << 1 | s1 << 1) & full if k > 1 else 0
                    if s1 or s2:
                        todo.append((child, s0, s1, s2))
        return found

    def _places(self, n: int) -> list[tuple]:
        """The plan for words of ``n`` characters as ``(from, to, hashes, roots)``: in order, the hashes of the parts and the roots of their tries."""
        if n not in self.places:
            at: dict[tuple, list] = {}
            for a, b, roots, _ in self.plans.get(n) or self.plan(n):
                at.setdefault((a, b), []).extend((_hash(part), self.root[id(trie)]) for part, trie in roots.items())
            self.places[n] = []
            for (a, b), rows in at.items():
                rows.sort()
                self.places[n].append((a, b, np.array([h for h, _ in rows], np.uint64), np.array([r for _, r in rows], np.int64)))
        return self.places[n]

    def _fuzzy_all(self, words: list[str]):
        """``fuzzy`` for words of one length (of ``WIDEST`` at most): triples of a word's place in the list, a term's number and the edits."""
        n = len(words[0])
        chars = np.array(words, f"U{n}").view(np.uint32).reshape(len(words), n)
        powers = np.array([pow(FACTOR, i, 1 << 64) for i in range(n)], np.uint64)
        sums = np.zeros((n + 1, len(words)), np.uint64)  # a part's hash is a difference of two
        np.cumsum((chars * powers).T, axis=0, out=sums[1:])
        word, node = [], []
        for a, b, hashes, roots in self._places(n):
            h = (sums[b] - sums[a]) * np.uint64(pow(FACTOR, -a, 1 << 64))
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            which = np.flatnonzero(high > low)
            of, at = _spread(low[which], (high - low)[which])
            word.append(which[of])
            node.append(roots[at])
        if not word:
            return
        word, node = np.concatenate(word), np.concatenate(node)
        if self.below[node].sum() > TOGETHER and len(words) > 1:
            half = len(words) // 2
            yield from self._fuzzy_all(words[:half])
            yield from ((w + half, t, d) for w, t, d in self._fuzzy_all(words[half:]))
            return
        # the states as in _fuzzy, of all words and tries at once, one character a step
        one, full = np.uint64(1), np.uint64((2 << n) - 1)
        r0 = np.full(len(word), 1, np.uint64)
        r1, r2 = r0 * np.uint64(3), np.where(self.two[node], np.uint64(7) & full, np.uint64(0))
        while len(word):
            of, node = _spread(self.first[node], self.count[node])
            word, r0, r1, r2 = word[of], r0[of], r1[of], r2[of]
            bits = np.packbits(chars[word] == self.char[node][:, None], axis=1, bitorder="little")
            m = np.zeros((len(word), 8), np.uint8)
            m[:, :bits.shape[1]] = bits
            m = m.view("<u8").ravel()
            s0 = (r0 & m) << one
            s1 = ((r1 & m) << one | r0 | r0 << one | s0 << one) & full
            s2 = np.where(self.two[node], ((r2 & m) << one | r1 | r1 << one | s1 << one) & full, np.uint64(0))
            end = np.flatnonzero(self.ends[node] >= 0)
            if len(end):
                term = self.ends[node[end]]
                accept = np.where(self.is_stem[term], full, one << np.uint64(n))
                by1, by2 = (s1[end] & accept) != 0, (s2[end] & accept) != 0
                got = np.flatnonzero((by1 | by2) & ((s0[end] & accept) == 0))
                yield from zip(word[end[got]].tolist(), term[got].tolist(), np.where(by1[got], 1, 2).tolist())
            go = np.flatnonzero((s1 | s2) != 0)
            word, node, r0, r1, r2 = word[go], node[go], s0[go], s1[go], s2[go]

    def _hits(self, word: str, near) -> tuple:
        """Hits of a word, given the terms it is like; a word that is itself a term is no misspelling of others."""
        hits = []
        is_term = word in self.terms
        if is_term:
            hits.append((word, 0))
        n, swapped = len(word), self.swapped.get(word, ())
        for k in STEM:
            if k > n:
                break
            start = word[:k]
            if start in self.beginnings:
                if start in self.stems:
                    hits.append((start + "*", 0))
                if k >= 5 and start in self.swapped_stems:
                    swapped = [*swapped, *self.swapped_stems[start]]
        if n >= 4 and not is_term and (near or swapped):
            edits = dict(near)
            for t in swapped:
                edits[t] = 1
            hits += sorted((x for x in edits.items() if (x[0], 0) not in hits), key=lambda x: (x[1], x[0]))
        return tuple(hits)

    def lookup(self, word: str) -> tuple:
        """Hits of a word: ``(term, edits)``."""
        return self._hits(word, self.fuzzy(word).items() if len(word) >= 4 and word not in self.terms else ())

    def lookups(self, words: list[str]):
        """Pairs of a word and its hits; words of one length are looked up together."""
        lengths: dict[int, list[str]] = {}
        for w in words:
            if 4 <= len(w) <= WIDEST and w not in self.terms:
                lengths.setdefault(len(w), []).append(w)
            else:
                yield w, self.lookup(w)
        for some in lengths.values():
            near: dict[int, list] = {}
            for i, t, d in self._fuzzy_all(some):
                near.setdefault(i, []).append(self.near[d][t])
            for i, w in enumerate(some):
                yield w, self._hits(w, near.get(i, ()))

    def hits(self, words: set[str]) -> dict[str, tuple]:
        """Those of the words that have hits, with them."""
        out, new = {}, []
        for w in words:
            got = self.known.get(w)
            if got is None:
                got = self.older.get(w)
                if got is None:
                    new.append(w)
                    continue
                self._remember(w, got)
            if got:
                out[w] = got
        for w, got in self.lookups(new):
            if len(w) <= LONGEST:
                self._remember(w, got)
            if got:
                out[w] = got
        return out

    def _remember(self, word: str, got: tuple) -> None:
        self.size += 160 + 4 * len(word) + 72 * len(got)  # the entry and its objects, roughly
        self.known[word] = got
        if self.size > REMEMBERED_BYTES // 2:
            self.known, self.older, self.size = {}, self.known, 0

    def features(self, text: str) -> list[float]:
        return self.features_of([text])[0]

    def features_of(self, texts: list[str]) -> list[list[float]]:
        """The hits of each text, weighed by their context, as numbers for the classifier."""
        lows = [t.lower() for t in texts]
        words = [WORDS.findall(t) for t in lows]
        hits = self.hits(set().union(*words))
        return [self._features(low, ws, hits) for low, ws in zip(lows, words)]

    def _features(self, low: str, words: list[str], hits: dict[str, tuple]) -> list[float]:
        got = list(map(hits.get, words))
        at = [i for i, h in enumerate(got) if h]
        if not at:
            return [0.0] * N_FEATURES
        n = len(at)
        # what depends on the words alone is counted once for each distinct word
        often: dict[str, int] = {}
        hits_of: dict[str, tuple] = {}
        for i in at:
            w = words[i]
            often[w] = often.get(w, 0) + 1
            hits_of[w] = got[i]
        count: dict[str, int] = {}
        edited = 0
        for w, hs in hits_of.items():
            exact = [t for t, d in hs if not d]
            for t in exact:
                count[t] = count.get(t, 0) + often[w]
            if not exact:
                edited += often[w]
        # only texts with quotation marks need the places of words
        spans = [m.span() for m in WORDS.finditer(low)] if QUOTE.search(low) else None
        addressed, reported = _around(words, ADDRESS), _around(words, REPORT)
        quoted = near = address = 0
        factors: set[tuple[str, float]] = set()
        before = -1 - WINDOW
        for i, after in zip(at, [*at[1:], len(words) + WINDOW + 1]):
            near += i - before <= WINDOW or after - i <= WINDOW
            before = i
            you, quote = addressed[i], reported[i]
            if spans and not quote:
                a, b = spans[i]
                quote = bool(QUOTE.search(low, max(0, a - 60), a) and QUOTE.search(low, b, b + 60))
            quoted, address = quoted + quote, address + you
            factors.add((words[i], 0.5 if quote and not you else 1.0))
        best: dict[str, float] = {}
        bent: dict[str, float] = {}
        for w, factor in factors:
            for t, d in hits_of[w]:
                # a term's weight by how often it occurs; that of misspelled ones is learned by itself
                if not d:
                    best[t] = max(best.get(t, -9.0), self.terms[t][min(count[t], 3) - 1] * factor)
                elif t not in count:
                    bent[t] = max(bent.get(t, -9.0), self.bent(t) * factor)
        tops = sorted(best.values(), reverse=True)[:5] or [0.0]
        bends = sorted((x for x in bent.values() if x > 0), reverse=True)[:3] or [0.0]
        return [tops[0], sum(tops[:3]), sum(max(x, 0.0) for x in tops), math.log1p(n), math.log1p(edited), quoted / n, near / n,
                address / n, min(1.0, 20.0 * n / len(words)), 1.0, bends[0], sum(bends)]

    def bent(self, term: str) -> float:
        """The weight of a term's misspellings."""
        w = self.terms[term]
        return w[3] if len(w) > 3 else 0.7 * w[0]


def _around(words: list[str], wanted: frozenset) -> bytearray:
    """1 for each place with one of the ``wanted`` within the window."""
    near = bytearray(len(words))
    if not wanted.isdisjoint(words):
        for i, w in enumerate(words):
            if w in wanted:
                a, b = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
                near[a:b] = b"\1" * (b - a)
    return near


def _hash(part: str) -> int:
    return sum(ord(c) * pow(FACTOR, i, 1 << 64) for i, c in enumerate(part)) % (1 << 64)


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``count`` numbers from ``first`` on: for each number the place of its run, and the number."""
    of = np.repeat(np.arange(len(first)), count)
    return of, np.arange(len(of)) + (first - (np.cumsum(count) - count))[of]


def pieces(texts):
    """Lists of about ``PIECE_BYTES`` of consecutive texts."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= PIECE_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def _strings(column: pa.Array):
    return (column[k].as_py() or "" for k in range(len(column)))


N_FEATURES = 12
_LAST: list[Lexicon] = []


def lexicon_of(terms: dict[str, tuple]) -> Lexicon:
    """The lexicon of ``terms``; a Python worker keeps its last one, with the words it remembers, for its next task."""
    if not _LAST or _LAST[0].terms != terms:
        _LAST[:] = [Lexicon(terms)]
    return _LAST[0]


def terms_of(text: str) -> dict[str, int]:
    """Every term of a text with its number of occurrences."""
    out: dict[str, int] = {}
    for w, n in Counter(WORDS.findall(text.lower())).items():
        if len(w) >= 3:
            out[w] = out.get(w, 0) + n
            for k in STEM:
                if k > len(w):
                    break
                stem = w[:k] + "*"
                out[stem] = out.get(stem, 0) + n
    return out


def _counts(batches):
    """For texts with labels ``(term, c0, ... c5)``: texts without and with the label that hold the term once, twice, three times
    at least.  A task has ``COUNTED`` terms and those of one text in memory at most; a term may come in several rows."""
    def rows():
        for some in range(0, len(total), ROWS):
            part = terms[some:some + ROWS]
            sixes = [[total[t] >> 32 * i & 0xFFFFFFFF for t in part] for i in range(6)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *[pa.array(c, pa.int64()) for c in sixes]],
                                             ["term", *[f"c{i}" for i in range(6)]])

    # six counters of 32 bits in one number; a term that occurs often counts at all levels up to three
    ones = [[sum(1 << 32 * (2 * level + y) for level in range(n)) for n in range(4)] for y in range(2)]
    total: dict[str, int] = {}
    for b in batches:
        for text, y in zip(_strings(b.column("text")), b.column("y").to_pylist()):
            one = ones[y]
            for t, n in terms_of(text).items():
                total[t] = total.get(t, 0) + one[n if n < 3 else 3]
            if len(total) >= COUNTED:
                terms = list(total)
                yield from rows()
                total = {}
    terms = list(total)
    yield from rows()


def learn_lexicon(train: DataFrame, n_pos: int, n_neg: int, max_terms: int = MAX_TERMS, least: int = 4) -> dict[str, tuple]:
    """Terms with weights, from the numbers of texts of either label that hold them."""
    table = train.select("text", "y").mapInArrow(_counts, "term string, " + ", ".join(f"c{i} long" for i in range(6)))
    sums = table.groupBy("term").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(6)])
    odds = lambda a, b: F.log((F.col(b) + 0.5) / (n_pos + 1)) - F.log((F.col(a) + 0.5) / (n_neg + 1))
    for level in range(3):
        sums = sums.withColumn(f"w{level}", odds(f"c{2 * level}", f"c{2 * level + 1}"))
    # seldom terms need clear evidence: a lower bound of the log odds orders them
    sure = F.col("w0") - 1.5 * F.sqrt(1 / (F.col("c1") + 0.5) + 1 / (F.col("c0") + 0.5))
    sure2 = F.col("w2") - 1.5 * F.sqrt(1 / (F.col("c5") + 0.5) + 1 / (F.col("c4") + 0.5))
    rows = (sums.withColumn("sure", F.greatest(sure, sure2)).filter((F.col("c1") >= least) & (F.col("sure") > 1.0))
            .orderBy(F.desc("sure"), "term").limit(max_terms).collect())
    # later levels are seldom: their weights are drawn to the first one
    out, seen = {}, {}
    for r in rows:
        w = [r["w0"]]
        for level in (1, 2):
            n = r[f"c{2 * level}"] + r[f"c{2 * level + 1}"]
            w.append((w[-1] * 4 + r[f"w{level}"] * n) / (4 + n))
        out[r["term"]], seen[r["term"]] = tuple(w), r["c1"]
    return prune(out, seen)


def prune(terms: dict[str, tuple], seen: dict[str, int]) -> dict[str, tuple]:
    """Of terms that say the same keep one: the word if most texts with a stem have that very
    word, else the shortest stem whose weight is about as high."""
    words = [t for t in terms if not t.endswith("*")]
    drop = {w[:k] + "*" for w in words for k in STEM if seen.get(w[:k] + "*", 0) * 0.8 <= seen[w]}
    kept: dict[str, tuple] = {}
    for t in sorted(terms, key=lambda t: (len(t.rstrip("*")), t)):
        stem = t.rstrip("*")
        above = [kept[stem[:k] + "*"] for k in STEM if k <= len(stem) and stem[:k] + "*" in kept]
        if t not in drop and not any(max(a) >= max(terms[t]) - 0.7 for a in above):
            kept[t] = terms[t]
    return kept


def weigh_edits(train: DataFrame, terms: dict[str, tuple], n_pos: int, n_neg: int) -> dict[str, tuple]:
    """Add to each term the weight of its misspellings: their log odds, drawn to 0.7 of the term's first weight."""
    def counts(batches):
        lexicon, total = lexicon_of(terms), Counter()
        for b in batches:
            labels = iter(b.column("y").to_pylist())
            for some in pieces(_strings(b.column("text"))):
                words = [set(WORDS.findall(text.lower())) for text in some]
                hits_of = lexicon.hits(set().union(*words))
                for ws, y in zip(words, labels):
                    hits = [h for w in ws if w in hits_of for h in hits_of[w]]
                    total.update((t, y) for t in {t for t, d in hits if d} - {t for t, d in hits if not d})
        terms_, labels, numbers = zip(*[(t, y, n) for (t, y), n in total.items()]) if total else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(terms_, pa.string()), pa.array(labels, pa.int32()), pa.array(numbers, pa.int64())],
                                         ["term", "y", "n"])

    table = train.select("text", "y").mapInArrow(counts, "term string, y int, n long")
    seen = {(r["term"], r["y"]): r["n"] for r in table.groupBy("term", "y").agg(F.sum("n").alias("n")).collect()}
    out = {}
    for t, w in terms.items():
        c1, c0 = seen.get((t, 1), 0), seen.get((t, 0), 0)
        odds = math.log((c1 + 0.5) / (n_pos + 1)) - math.log((c0 + 0.5) / (n_neg + 1))
        out[t] = (*w, (0.7 * w[0] * 4 + odds * (c1 + c0)) / (4 + c1 + c0))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights of logistic regression with a ridge, by Newton's method; the last column is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN, id_col: str = "doc_id",
        text_col: str = "text") -> dict:
    """The model: lexicon terms and the classifier's weights (both of bounded size)."""
    train = training_texts(docs, labels, label, max_train, id_col, text_col)
    by = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = by.get(1, 0), by.get(0, 0)
    if not pos or not neg:
        return {"terms": {}, "w": None, "base": pos / (pos + neg) if pos + neg else 0.0}
    terms = learn_lexicon(train, pos, neg)
    terms = weigh_edits(train, terms, pos, neg)

    def rows(batches):
        lexicon = lexicon_of(terms)
        for b in batches:
            x = [f for some in pieces(_strings(b.column("text"))) for f in lexicon.features_of(some)]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    got = train.select("text", "y").mapInArrow(rows, "y int, x array<double>").collect()
    x = np.array([design(r["x"]) for r in got])
    return {"terms": terms, "w": fit_logistic(x, np.array([r["y"] for r in got], float)), "base": 0.0}


def design(f: list[float]) -> list[float]:
    """Features with the constant last (the tenth feature is 1 if there is any hit)."""
    return [*[v / s for v, s in zip(f, (4, 8, 10, 1, 1, 1, 1, 1, 1, 1, 4, 8))], 1.0]


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score", keep_text: bool = True) -> DataFrame:
    """Add ``out``: the probability of label 1."""
    terms, w, base = model["terms"], model["w"], model["base"]
    kept = [f for f in docs.schema.fields if f.name != out and (keep_text or f.name != text_col)]
    names = [f.name for f in kept]

    def run(batches):
        lexicon = lexicon_of(terms)
        for b in batches:
            first = 0
            for some in pieces(_strings(b.column(text_col))):
                if w is None:
                    values = [base] * len(some)
                else:
                    zs = [float(np.dot(design(f), w)) for f in lexicon.features_of(some)]
                    values = [1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) for z in zs]
                part = b.slice(first, len(values))
                first += len(values)
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(values, pa.float64())], [*names, out])

    return docs.select(*dict.fromkeys([*names, text_col])).mapInArrow(run, T.StructType(kept + [T.StructField(out, T.DoubleType())]))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model, keep_text=False)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
