"""Repeated byte strings by range-partitioned suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts anywhere else is removed.

Sorting all suffixes would move ``length`` bytes per byte of text, so a sparse set of suffixes is
sorted that still settles every window of ``length`` bytes exactly:

1. Anchors: of each window the position whose ``GRAM`` bytes hash lowest (leftmost of ties).  Equal windows
   choose the same anchor, so two equal windows contain two equal anchors at the same offset; an anchor keeps the range of
   offsets at which windows chose it, and answers for those alone (one each in a run of one character).
2. Anchors whose GRAM bytes occur once are dropped (map-side combined minimum and maximum of
   where they occur); the others are the suffixes.
3. Sampled splitters range-partition the suffixes by their leading bytes.  A lead with more than
   ``HOT`` suffixes is divided: windows are dealt into classes by their offset from the anchor, and a
   class leads with all bytes its windows have in common (at least 183 of 200).  A class that still has more
   than ``HOT`` suffixes with one lead is divided into its single windows; sampled splitters range-partition them by
   window and place, and each is compared with the one before it in the sorted stream, also across the boundaries of the
   partitions, so memory does not depend on how many texts share a passage.
4. Buckets are sorted by multikey quicksort, 8 bytes a key, to the right of the anchor and, reversed, to the left.
   Neighbours' common lengths cut either order into runs for each offset; two suffixes in the same run of both have an
   equal window there.  Rows of one lead are never parted, and a part of a bucket ends at a
   lead's boundary, so nothing is missed between parts.
5. Windows found are joined to maximal runs per text and cut out.

Copies of a whole text are one text: with at least ``length`` bytes they are removed altogether, and one of them
stands for all in the search.

Nulls and edge cases: a null text is empty; texts shorter than ``length`` keep all; null and repeated ids are carried through (rows, not ids,
are compared); an empty table gives an empty result.  Only id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialize
from .jaccard_join import _BYTES, _mix, _powers

LENGTH, GRAM = 200, 64
HOT, CLASSES = 20_000, 8
CHUNK = 5_000  # suffixes compared at once
BATCH_BYTES = 700_000
PIECE = 1 << 17  # bytes hashed at once; positions in a piece are packed into 23 bits
OUT = 2_000  # rows of an output batch
MAX_SMALL, MAX_KEYS, MAX_BYTES = 200_000, 1_000_000, 8_000_000  # rows, keys and bytes sent to all tasks; more are joined by a shuffle

# the bytes' values without the folding of letters
_VALUES = _BYTES.copy()
_VALUES[65:91] = np.random.default_rng(12).integers(1, 2**63, 26, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def anchors(raw: list[bytes], length: int = LENGTH, gram: int = GRAM) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of the anchors of each text; a place packs the position and the least and largest offset of the
    anchor in the windows that chose it."""
    sizes = np.array([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if len(data) < length:
        return [none for _ in raw]
    ends = np.cumsum(sizes)
    found = []
    step = PIECE
    power, inverse = _powers(step + 2 * length + 1)[:2]
    for at in range(0, len(data), step):  # pieces overlap by a window, so a long text is one text
        part = data[at:at + step + length]
        if len(part) < length:
            break
        total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUES[part] * power[:len(part)])])
        n = len(part) - gram + 1
        value = _mix((total[gram:] - total[:n]) * inverse[:n])
        key = (value >> np.uint64(23) << np.uint64(23)) | np.arange(n, dtype=np.uint64)
        width, least = 1, key
        wide = length - gram + 1
        while width * 2 <= wide:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wide:
            least = np.minimum(least[:len(least) - (wide - width)], least[wide - width:])
        start = np.arange(min(len(least), step)) + at
        inside = ends[np.searchsorted(ends, start, side="right")] - start >= length
        p = (least[:len(start)][inside] & np.uint64((1 << 23) - 1)).astype(np.int64)
        if len(p):  # later windows choose later anchors
            new = np.concatenate([[True], p[1:] != p[:-1]])
            far = start[inside][new]
            near = start[inside][np.concatenate([new[1:], [True]])]
            p = p[new]
            found.append((value[p].view(np.int64), p + at, p + at - near, p + at - far))
    if not found:
        return [none for _ in raw]
    h, p, low, high = (np.concatenate(c) for c in zip(*found))
    p, first, which = np.unique(p, return_index=True, return_inverse=True)
    h, low, high = h[first], _by(np.minimum, low, which), _by(np.maximum, high, which)
    cut = np.searchsorted(p, ends)
    begin = np.concatenate([[0], cut[:-1]])
    return [(h[a:b], (p[a:b] - (e - s) << 24) | (low[a:b] << 12) | high[a:b])
            for a, b, e, s in zip(begin.tolist(), cut.tolist(), ends.tolist(), sizes.tolist())]


def _by(least_or_most, values: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The least or largest value of each group; anchors on the border of two pieces are found in both."""
    order = np.argsort(which, kind="stable")
    return least_or_most.reduceat(values[order], np.searchsorted(which[order], np.arange(which.max() + 1)))


def _place(packed: int) -> tuple[int, int, int]:
    """Position, least and largest offset."""
    return packed >> 24, packed >> 12 & 4095, packed & 4095


def _texts(column):
    part, size, first = [], 0, 0
    for k in range(len(column)):
        t = (column[k].as_py() or "").encode("utf-8", "surrogatepass")
        part.append(t)
        size += len(t)
        if size >= BATCH_BYTES:
            yield first, part
            part, size, first = [], 0, k + 1
    if part:
        yield first, part


def multikey_order(group: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Order of rows by group, then by their keys from left to right; settled rows leave early."""
    order = np.argsort(group, kind="stable")
    g = group[order]
    # a class is named by the first position of its rows, so classes stay in order
    cls = np.maximum.accumulate(np.where(np.concatenate([[True], g[1:] != g[:-1]]), np.arange(len(g)), 0))
    live = np.arange(len(order))
    for c in range(keys.shape[1]):
        # positions of the order whose class has more than one row
        same = np.concatenate([[False], cls[live][1:] == cls[live][:-1]])
        live = live[same | np.concatenate([same[1:], [False]])]
        if not len(live):
            break
        rows, col = order[live], keys[order[live], c]
        by = np.lexsort((col, cls[live]))
        order[live] = rows[by]
        k, g = col[by], cls[live][by]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])])
        cls[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
    return order


def _matrix(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(v) for v in values])
    flat = np.frombuffer(b"".join([v[:width].ljust(width, b"\0") for v in values]), np.uint8)
    return flat.reshape(len(values), width), size


def _sorted_runs(group, values, width):
    """Order, and for each place in it the length shared with the place before (0 for the first of a group)."""
    m, size = _matrix(values, width)
    # of values that are equal but for the padding the shorter comes first, so it never parts two longer ones
    by = np.argsort(size, kind="stable")
    order = by[multikey_order(group[by], m[by].view(">u8").astype(np.uint64))]
    a, b = order[:-1], order[1:]
    diff = m[a] != m[b]
    share = np.where(diff.any(axis=1), diff.argmax(axis=1), width)
    share = np.minimum(share, np.minimum(size[a], size[b]))
    share[group[a] != group[b]] = -1
    return order, np.concatenate([[-1], share]), size


def repeated_windows(group, left: list[bytes], right: list[bytes], low, high, length: int = LENGTH):
    """For each suffix the least and largest offset of an anchor in a window that another suffix of its
    group repeats (-1 if there is none).  ``left`` is reversed; ``low .. high`` are the offsets a row may answer."""
    n = len(group)
    first, last = np.full(n, -1), np.full(n, -1)
    if n < 2:
        return first, last
    pad = lambda w: -(-w // 8) * 8
    ro, rs, rsize = _sorted_runs(group, right, pad(length))
    lo, ls, lsize = _sorted_runs(group, left, pad(max(1, int(high.max()))))
    rplace, lplace = np.empty(n, np.int64), np.empty(n, np.int64)
    rplace[ro], lplace[lo] = np.arange(n), np.arange(n)
    for o in range(int(low.min()), int(high.max()) + 1):
        ok = np.flatnonzero((low <= o) & (o <= high) & (lsize >= o) & (rsize >= length - o))
        if len(ok) < 2:
            continue
        run_r = np.cumsum(rs < length - o)[rplace[ok]]
        run_l = np.cumsum(ls < o)[lplace[ok]]
        key = run_r * (n + 1) + run_l
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        hit = ok[by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        first[hit] = np.where(first[hit] < 0, o, first[hit])
        last[hit] = o
    return first, last


_SUFFIX = "digest binary, pos long, lead binary, low int, high int, left binary, right binary"
_TYPES = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}


def _emit(df: DataFrame, rows_of, schema: str) -> DataFrame:
    """The tuples ``rows_of(digest, text, hits)`` yields for each row, in batches of bounded size."""
    names, types = zip(*[c.split() for c in schema.split(", ")])

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(zip(*out), types)], list(names))

    def run(batches):
        out = []
        for b in batches:
            for d, t, hits in zip(b.column("digest"), b.column("text"), b.column("hits")):
                for row in rows_of(d.as_py(), (t.as_py() or "").encode("utf-8", "surrogatepass"), hits.as_py()):
                    out.append(row)
                    if len(out) >= OUT:
                        yield batch(out)
                        out = []
        if out:
            yield batch(out)

    return df.select("digest", "text", "hits").mapInArrow(run, schema)


def _classes(low: int, high: int, wide: int):
    """``class, least, largest`` of the classes of offsets that ``low .. high`` meets.

    All windows of a class around an anchor at ``p`` hold the bytes from ``p - least`` to ``p + length - largest``.
    """
    step = -(-wide // CLASSES)
    for c in range(low // step, high // step + 1):
        yield c, c * step, min((c + 1) * step, wide) - 1


def _class_leads(search: DataFrame, length: int, gram: int) -> DataFrame:
    """``digest, pos, class, key`` of the classes of hot anchors; ``key`` stands for the class and its lead."""
    wide = length - gram + 1

    def rows_of(d, t, hits):
        for h in hits:
            if h["hot"]:
                p, low, high = _place(h["pos"])
                for c, lo, hi in _classes(low, high, wide):
                    lead = bytes([c]) + t[p - lo:p + length - hi]
                    yield d, h["pos"], c, int.from_bytes(hashlib.blake2b(lead, digest_size=8).digest(), "little", signed=True)

    return _emit(search, rows_of, "digest binary, pos long, class int, key long")


def _suffixes(search: DataFrame, length: int, gram: int) -> DataFrame:
    """The suffixes at each text's ``hits`` (place, heat, bits of the classes left to `_windows`)."""
    wide = length - gram + 1

    def rows_of(d, t, hits):
        for h in hits:
            p, low, high = _place(h["pos"])
            if not h["hot"]:
                yield d, p, b"\xff" + t[p:p + gram], low, high, t[p - high:p][::-1], t[p:p + length - low]
                continue
            for c, lo, hi in _classes(low, high, wide):
                if not h["deep"] >> c & 1:
                    lead, lo, hi = bytes([c]) + t[p - lo:p + length - hi], max(lo, low), min(hi, high)
                    yield d, p, lead, lo, hi, t[p - hi:p][::-1], t[p:p + length - lo]

    return _emit(search, rows_of, _SUFFIX)


def _windows(search: DataFrame, length: int, gram: int) -> DataFrame:
    """``digest, start, window`` of every window of the classes marked in ``deep``."""
    wide = length - gram + 1

    def rows_of(d, t, hits):
        for h in hits:
            p, low, high = _place(h["pos"])
            for c, lo, hi in _classes(low, high, wide):
                if h["deep"] >> c & 1:
                    for o in range(max(lo, low), min(hi, high) + 1):
                        yield d, p - o, t[p - o:p - o + length]

    return _emit(search.filter(F.exists("hits", lambda h: h["deep"] > 0)), rows_of, "digest binary, start long, window binary")


def _window_spans(windows: DataFrame, length: int) -> DataFrame:
    """``digest, start, stop`` of the windows that stand at two places or more.

    In the sorted stream equal windows are neighbours; rows of one place count once.  A partition gives the ends of
    its first and last run of equal windows with the window, which are compared among the partitions.
    """
    def run(batches):
        out: list[tuple] = []
        last = None  # window and place of the row before
        alone = False  # whether that place is the only one of its run so far
        opening = True  # whether the run is the partition's first

        def give(place, window):
            out.append((*place, place[1] + length, window))

        def batch():
            cols = list(zip(*out)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.binary()))],
                                              ["digest", "start", "stop", "edge"])

        for b in batches:
            for d, s, w in zip(b.column("digest"), b.column("start"), b.column("window")):
                place, w = (d.as_py(), s.as_py()), w.as_py()
                if last is not None and last[0] == w:
                    if last[1] == place:
                        continue
                    if alone:
                        give(last[1], None)
                    give(place, None)
                    alone = False
                else:
                    if last is not None and opening:
                        give(last[1], last[0])
                        opening = False
                    alone = True
                last = (w, place)
                if len(out) >= OUT:
                    yield batch()
        if last is not None:
            give(last[1], last[0])
        yield batch()

    order = ("window", "digest", "start")
    found = windows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "digest binary, start long, stop long, edge binary")
    found = materialize(found, "suffix-windows")
    edges = found.filter("edge is not null")  # two rows of a partition at most
    twice = edges.groupBy("edge").agg(F.min(F.struct("digest", "start")).alias("a"), F.max(F.struct("digest", "start")).alias("b")).filter("a <> b")
    across = edges.join(twice.select("edge"), "edge", "left_semi")
    return found.filter("edge is null").select("digest", "start", "stop").unionByName(across.select("digest", "start", "stop"))


def _spans(suffixes: DataFrame, length: int) -> DataFrame:
    """``digest, start, stop`` of repeated stretches, from suffixes sorted by lead."""
    def settle(rows):
        lead = [r[2] for r in rows]
        group = np.cumsum([0] + [x != y for x, y in zip(lead[1:], lead)])
        low, high = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
        first, last = repeated_windows(group, [r[5] for r in rows], [r[6] for r in rows], low, high, length)
        keep = np.flatnonzero(first >= 0).tolist()
        return pa.RecordBatch.from_arrays([
            pa.array([rows[k][0] for k in keep], pa.binary()),
            pa.array([rows[k][1] - int(last[k]) for k in keep], pa.int64()),
            pa.array([rows[k][1] - int(first[k]) + length for k in keep], pa.int64())], ["digest", "start", "stop"])

    def run(batches):
        rows: list[tuple] = []
        for whole in batches:
            for at in range(0, whole.num_rows, OUT):
                rows.extend(zip(*[c.to_pylist() for c in whole.slice(at, OUT).columns]))
                if len(rows) >= CHUNK:
                    end = len(rows)  # the last lead may go on
                    while end and rows[end - 1][2] == rows[-1][2]:
                        end -= 1
                    if end:
                        yield settle(rows[:end])
                        rows = rows[end:]
        if rows:
            yield settle(rows)

    ranged = suffixes.repartitionByRange("lead").sortWithinPartitions("lead")
    return ranged.mapInArrow(run, "digest binary, start long, stop long")


def _merged(spans: DataFrame) -> DataFrame:
    """A text's spans as maximal runs: pairs of little-endian 64-bit numbers."""
    def run(batches):
        for b in batches:
            out = []
            for s in b.column("spans").to_pylist():
                runs: list[list[int]] = []
                for x, y in sorted((v["start"], v["stop"]) for v in s):
                    if runs and x <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], y)
                    else:
                        runs.append([x, y])
                out.append(np.array(runs, "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(out, pa.binary())], ["digest", "spans"])

    return spans.mapInArrow(run, "digest binary, spans binary")


def _small(df: DataFrame, rows: int = MAX_SMALL) -> DataFrame:
    """``df`` sent to all tasks if it is counted to be small, in rows and in bytes of its spans."""
    size = F.sum(F.octet_length("spans")) if "spans" in df.columns else F.lit(0)
    n = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(size, F.lit(0)).alias("size")).first()
    return F.broadcast(df) if n["n"] <= rows and n["size"] <= MAX_BYTES else df


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``id, text, copies, spans`` of each row; ``spans`` (packed pairs start, stop in bytes) lists maximal repeated runs of
    texts that occur once, and ``copies`` is the number of rows of texts that occur more often (else null)."""
    if not gram <= length < gram + 4096:  # offsets are packed into 12 bits
        raise ValueError("length must be at least gram and less than gram + 4096")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digest", F.unhex(F.md5("text")))

    def find(batches):
        for b in batches:
            for first, raw in _texts(b.column("text")):
                found = anchors(raw, length, gram)
                yield pa.RecordBatch.from_arrays([
                    b.column("digest").slice(first, len(raw)), pa.array([h for h, _ in found], pa.list_(pa.int64())),
                    pa.array([p for _, p in found], pa.list_(pa.int64()))], ["digest", "h", "p"])

    found = materialize(rows.select("digest", "text").mapInArrow(find, "digest binary, h array<long>, p array<long>")
                        .filter(F.size("h") > 0), "suffix-anchors")
    each = (found.select("digest", F.explode(F.arrays_zip("h", "p")).alias("a"))
            .select("digest", F.col("a.h").alias("h"), F.col("a.p").alias("pos")))
    where = F.xxhash64("digest", "pos")  # where an anchor occurs; the same in copies of a text
    shared = each.groupBy("h").agg(F.min(where).alias("lo"), F.max(where).alias("hi"), F.count("*").alias("k")).filter("lo <> hi")
    hits = each.join(shared.select("h", (F.col("k") > hot).alias("hot")), "h").groupBy("digest", "pos").agg(F.max("hot").alias("hot"))
    hits = materialize(hits.groupBy("digest").agg(F.collect_list(F.struct("pos", "hot", F.lit(0).alias("deep"))).alias("hits")), "suffix-hits")
    copies = materialize(rows.groupBy("digest").agg(F.count("*").alias("copies"), F.min("id").alias("one")).filter("copies > 1"),
                         "suffix-copies")
    known = rows.join(_small(copies), "digest", "left")
    # one row of each text; rows that repeat id and text are told apart below
    single = known.filter(F.col("copies").isNull() | F.col("id").eqNullSafe(F.col("one"))).select("digest", "text")

    def search(hits):
        return single.join(_small(hits.select("digest"), MAX_KEYS), "digest", "left_semi").join(hits, "digest")

    windows = None
    warm = hits.filter(F.exists("hits", lambda h: h["hot"]))
    if warm.limit(1).count():
        leads = materialize(_class_leads(search(warm), length, gram), "suffix-leads")
        many = leads.groupBy("key").agg(F.count("*").alias("k")).filter(F.col("k") > hot).select("key")
        deep = leads.join(many, "key", "left_semi").distinct().groupBy("digest", "pos").agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("class"))).alias("deep"))
        deep = materialize(deep.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("pos", "deep"))).alias("bits")), "suffix-deep")
        if deep.limit(1).count():
            marked = F.transform("hits", lambda h: F.struct(
                h["pos"].alias("pos"), h["hot"].alias("hot"), F.coalesce(F.try_element_at("bits", h["pos"]), F.lit(0)).alias("deep")))
            hits = materialize(hits.join(deep, "digest", "left").select("digest", marked.alias("hits")), "suffix-hits")
            windows = _windows(search(hits), length, gram)
    suffixes = _suffixes(search(hits), length, gram)
    if copies.filter("one is null").limit(1).count() or _repeats(rows, copies):
        suffixes = suffixes.dropDuplicates(["digest", "pos", "low"])
    spans = _spans(suffixes, length)
    if windows is not None:
        spans = spans.unionByName(_window_spans(windows, length))
    spans = spans.groupBy("digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = materialize(_merged(spans), "suffix-spans")
    return known.join(_small(spans), "digest", "left").select("id", "text", "copies", "spans")


def _repeats(rows: DataFrame, copies: DataFrame) -> bool:
    """Whether any id stands with the same text twice."""
    named = rows.join(_small(copies.select("digest", "one")), "digest").filter("id = one")
    return named.groupBy("digest").agg(F.count("*").alias("k")).filter("k > 1").limit(1).count() > 0


def cut_out(raw: bytes, spans, copies, length: int) -> tuple[bytes, int]:
    """What is left of a text and the number of maximal removed runs."""
    if copies is not None and len(raw) >= length:
        return b"", 1
    runs = np.frombuffer(spans or b"", "<i8").reshape(-1, 2).tolist()
    ends = [0, *[y for _, y in runs]]
    return b"".join([raw[a:b] for a, b in zip(ends, [*[x for x, _ in runs], len(raw)])]), len(runs)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **args) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` (binary) of each row."""
    found = repeated_spans(docs, id_col, text_col, length, **args)
    return _cut(found, length, {"kept": "binary"}, lambda left: (left,))


def _cut(found: DataFrame, length: int, added: dict, result) -> DataFrame:
    id_type = dict(found.dtypes)["id"]
    arrow = {"binary": pa.large_binary(), "string": pa.string()}

    def run(batches):
        for b in batches:
            rows = []
            for t, c, s in zip(b.column("text"), b.column("copies"), b.column("spans")):
                raw = t.as_py().encode("utf-8", "surrogatepass")
                left, runs = cut_out(raw, s.as_py(), c.as_py(), length)
                rows.append((len(raw), len(raw) - len(left), runs, *result(left)))
            cols = list(zip(*rows)) or [()] * (3 + len(added))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 *[pa.array(c, arrow[t]) for c, t in zip(cols[3:], added.values())]],
                ["id", "n_bytes", "n_removed", "n_spans", *added])

    extra = "".join(f", {k} {t}" for k, t in added.items())
    return found.mapInArrow(run, f"id {id_type}, n_bytes long, n_removed long, n_spans long{extra}")


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = _cut(repeated_spans(docs), LENGTH, {"kept_sha256": "string"}, lambda left: (hashlib.sha256(left).hexdigest(),))
    return out.withColumnRenamed("id", "doc_id")
