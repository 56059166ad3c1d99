"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

Encoding follows the definition: the normalised text is a chain of characters; an agenda
holds every adjacent pair whose concatenation is a piece, ordered by score (ties: leftmost);
the best pair is merged and its new neighbours enter the agenda, until it is empty;
symbols that are no piece fall back to their UTF-8 bytes.

The agenda runs on stretches that no merge can leave: no piece has a word-begin mark after
another character, and no piece holds a newline (both are verified when the vocabulary is
loaded), so a text is cut before each run of marks and around newlines.  The new short
stretches of an Arrow batch are merged together: a matrix holds one agenda per row, and
each step takes the best pair of every row.  Long stretches use a heap.  Results of short
stretches are remembered in a table of bounded size; every stretch that is encoded anew is
checked against the sentencepiece library, once per batch; a difference is an error.

Decoding is the library's ``decode`` of all ids.

Nulls and edge cases: a null text is encoded as the empty text (begin and end id only); a null
id is carried through; repeated rows are encoded each; a very long stretch without blanks
takes O(n log n); an empty table gives an empty result; other columns are passed
through by :func:`encode` and must not be called like the added ones (they are replaced).
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
REMEMBERED = 700_000  # stretches per worker
SHORT = 48  # characters of a stretch that is remembered
NEVER = 1 << 30
BATCH_CHARS = 3_000_000


class PieceModel:
    """A merge-type vocabulary: pieces with scores, byte fallback, begin and end ids."""

    def __init__(self, path: str):
        import sentencepiece
        self.lib = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.scores, self.bytes = {}, {}, [None] * 256
        for i in range(lib.get_piece_size()):
            p = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(p[3:-1], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                if re.search(f"[^{MARK}]{MARK}|\n", p):
                    raise ValueError(f"piece {i} may cross a word begin or a newline")
                self.ids[p], self.scores[p] = i, lib.get_score(i)
        if None in self.bytes:
            raise ValueError("the vocabulary has no byte fallback")
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        self.newline = struct.pack("<I", self.bytes[10])
        self.known: dict[str, bytes] = {}
        self.unchecked: list[tuple[str, bytes]] = []
        self._tables()

    def _tables(self) -> None:
        """Characters and pairs as numbers, for the matrix of agendas."""
        self.base = self.lib.get_piece_size()
        pieces = list(self.scores)
        ranks = {v: k for k, v in enumerate(sorted(set(self.scores.values()), reverse=True))}
        symbol = dict(self.ids)
        self.chars = np.arange(0x110000, dtype=np.int64) + self.base  # no piece: number + base
        for p in pieces:
            if len(p) == 1:
                self.chars[ord(p)] = self.ids[p]
        number = lambda p: symbol.get(p, self.chars[ord(p)] if len(p) == 1 else None)
        pairs = [(a << 32 | b, ranks[self.scores[p]], self.ids[p]) for p in pieces for i in range(1, len(p))
                 if (a := number(p[:i])) is not None and (b := number(p[i:])) is not None]
        pairs.sort()
        self.pair_keys, self.pair_ranks, self.pair_ids = np.array(pairs, dtype=np.int64).T.copy()

    def _ranks(self, a, b):
        """Rank (0: best score) of the merge of each pair; NEVER if the pair is no piece."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (a >= 0) & (b >= 0), self.pair_ranks[at], NEVER)

    def merge_many(self, stretches: list[str]) -> list[bytes]:
        """Ids of short stretches: row by row the same steps as :meth:`merge`, all rows at once."""
        size = np.array([len(s) for s in stretches])
        flat = self.chars[np.frombuffer("".join(stretches).encode("utf-32-le"), "<u4")]
        n, width = len(stretches), int(size.max()) + 1
        sym = np.full((n, width), -1, dtype=np.int64)
        sym[np.arange(width)[None, :] < size[:, None]] = flat
        rank = self._ranks(sym[:, :-1], sym[:, 1:])
        live = np.arange(n)
        work, agenda = sym, rank
        while True:
            best = agenda.argmin(axis=1)
            top = agenda[np.arange(len(live)), best]
            go = top < NEVER
            if not go.all():
                sym[live[~go], :work.shape[1]] = work[~go]
                live, work, agenda, best, top = live[go], work[go], agenda[go], best[go], top[go]
            if not len(live):
                break
            row = np.arange(len(live))
            # the right symbol of the merged pair goes, everything after it moves up
            keys = work[row, best] << 32 | work[row, best + 1]
            merged = self.pair_ids[np.searchsorted(self.pair_keys, keys)]
            src = np.arange(width - 1)[None, :]
            src = src + (src > best[:, None])
            work[:, :-1] = np.take_along_axis(work, src, axis=1)
            work[:, -1] = -1
            work[row, best] = merged
            agenda[:, :-1] = np.take_along_axis(agenda, src[:, :-1], axis=1)
            agenda[:, -1] = NEVER
            agenda[row, best] = self._ranks(work[row, best], work[row, best + 1])
            has_left = best > 0
            r, j = row[has_left], best[has_left]
            agenda[r, j - 1] = self._ranks(work[r, j - 1], work[r, j])
        base = self.base
        odd = (sym >= base).any(axis=1)
        valid = sym >= 0
        packed = sym[valid].astype("<u4").tobytes()
        ends = (np.cumsum(valid.sum(axis=1)) * 4).tolist()
        out = [packed[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.flatnonzero(odd).tolist():
            ids = [x for y in sym[i].tolist() if y >= 0
                   for x in ([y] if y < base else [self.bytes[c] for c in chr(y - base).encode()])]
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def merge(self, stretch: str) -> list[int]:
        """Ids of a stretch (blanks already written as marks) by the agenda."""
        scores = self.scores
        sym = list(stretch)
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n:
                s = scores.get(sym[a] + sym[b])
                if s is not None:
                    heapq.heappush(agenda, (-s, a, b, len(sym[a]) + len(sym[b])))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            if not sym[a] or not sym[b] or len(sym[a]) + len(sym[b]) != size or right[a] != b:
                continue  # one of the two has been merged since
            sym[a] += sym[b]
            sym[b] = ""
            right[a] = right[b]
            if right[b] < n:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        out = []
        for s in sym:
            if s:
                i = self.ids.get(s)
                out.extend([i] if i is not None else [self.bytes[x] for x in s.encode()])
        return out

    def learn(self, stretches) -> dict[str, bytes]:
        """Encode stretches that are not remembered, and remember the short ones."""
        short = sorted((s for s in stretches if len(s) <= SHORT), key=len)
        done, at = {}, 0
        for limit in (6, 9, 12, 16, 24, SHORT):  # rows of similar length share a matrix
            end = at
            while end < len(short) and len(short[end]) <= limit:
                end += 1
            for k in range(at, end, 50_000):
                part = short[k:min(k + 50_000, end)]
                done.update(zip(part, self.merge_many(part)))
            at = end
        for s in stretches:
            if s not in done:
                ids = self.merge(s)
                done[s] = struct.pack(f"<{len(ids)}I", *ids)
        self.unchecked.extend(done.items())
        return done

    def cut(self, text: str) -> list[str]:
        """The stretches of a text, newlines included."""
        if not text:
            return []
        chain = MARK + text.replace(" ", MARK)
        out = []
        for line in chain.split("\n"):
            words = line.split(MARK)
            if "" in words[1:]:  # an empty word is a further mark of the run before the next word
                out += re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", line)
            else:
                if words[0]:
                    out.append(words[0])
                out += [MARK + w for w in words[1:]]
            out.append("\n")
        out.pop()
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts without begin and end, as little-endian 32-bit integers, checked."""
        cuts = [self.cut(t) for t in texts]
        used = set().union(*cuts)
        used.discard("\n")
        new = self.learn(used.difference(self.known))
        self.check()
        known = self.known
        known.update(new)
        known["\n"] = self.newline
        out = [b"".join([known[p] for p in c]) for c in cuts]
        for s in new:
            if len(s) > SHORT:
                del known[s]
        if len(known) > REMEMBERED:  # what this batch used stays
            self.known = {s: known[s] for s in used if s in known}
        return out

    def check(self) -> int:
        """Compare what was encoded since the last call with the library; how many stretches.

        Stretches with one mark are put side by side as the words of one text, which also
        tests that no merge crosses a cut.
        """
        todo, self.unchecked = self.unchecked, []
        words = [x for x in todo if x[0][0] == MARK and len(x[0]) > 1 and x[0][1] != MARK]
        rest = [x for x in todo if not (x[0][0] == MARK and len(x[0]) > 1 and x[0][1] != MARK)]
        for at in range(0, len(words), 500):
            part = words[at:at + 500]
            ids = self.lib.encode("".join([s for s, _ in part])[1:])
            if np.array(ids, "<u4").tobytes() != b"".join([b for _, b in part]):
                rest += part
        # the library puts a mark before each text, so a stretch without one goes after a newline
        texts = [s[1:].replace(MARK, " ") if s[0] == MARK and len(s) > 1 else "\n" + s.replace(MARK, " ")
                 for s, _ in rest]
        for (s, packed), t, ids in zip(rest, texts, self.lib.encode(texts, num_threads=1)):
            want = ids[2:] if t[0] == "\n" else ids
            if struct.pack(f"<{len(want)}I", *want) != packed:
                raise ValueError(f"encoding differs from the library: {s!r}")
        return len(todo)


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Add ``ids`` (binary: little-endian 32-bit ids with begin and end) and ``decoded`` (string)."""
    return _run(docs, model_path, text_col, {"ids": "binary", "decoded": "string"},
                lambda ids, text: (ids, text))


def encode_digests(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; the text itself is not passed on."""
    return _run(docs, model_path, text_col, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
                lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                                   hashlib.sha256(text.encode()).hexdigest()), drop=(text_col,))


def _run(docs: DataFrame, model_path: str, text_col: str, added: dict, result, drop=()) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in added and f.name not in drop]
    schema = T.StructType(kept + [T.StructField(n, T._parse_datatype_string(t)) for n, t in added.items()])
    names = [f.name for f in kept]
    arrow = {"binary": pa.large_binary(), "string": pa.large_string(), "bigint": pa.int64()}

    def parts(batches):
        model = load(model_path)
        begin, end = struct.pack("<I", model.bos), struct.pack("<I", model.eos)
        for whole in batches:
            at = 0
            while at < whole.num_rows:  # batches of bounded text
                texts, size, start = [], 0, at
                while at < whole.num_rows and (at == start or size < BATCH_CHARS):
                    texts.append(whole.column(text_col)[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                ids = [begin + x + end for x in model.encode_many(texts)]
                decoded = model.lib.decode([np.frombuffer(x, "<u4").tolist() for x in ids])
                rows = [result(i, d) for i, d in zip(ids, decoded)]
                piece = whole.slice(start, at - start)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(n) for n in names]
                    + [pa.array([r[k] for r in rows], arrow[t]) for k, t in enumerate(added.values())],
                    names + list(added))

    return docs.select(*dict.fromkeys([*names, text_col])).mapInArrow(parts, schema)


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))
