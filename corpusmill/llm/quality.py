"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes.  Each passage is described by counts of
kinds of characters and by how its words repeat, and encoded by a small network; a gated
attention, learned from the documents' labels alone, weighs the passages; the weighted sum
of the passages' encodings is scored:

    h = tanh(W x),  a = softmax(w . (tanh(V h) * sigmoid(U h))),  p = sigmoid(c . sum(a h) + b)

Training uses at most ``max_train`` labelled rows that are not held out (the bound on the
classifier's sample) and every passage of them; scoring reads every passage of every text.

Nulls and edge cases: a null or empty text is a bag with one empty passage and is scored as such; rows with a null label
are not learned from; without rows of both labels every score is the share of label 1 (0.5 without rows);
a null id is held out; repeated rows are scored each; an empty table gives an empty result.  Other columns are passed through.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import held_out, training_texts

PASSAGE = 512
MAX_TRAIN = 6_000
HIDDEN, GATE = 16, 8
BATCH_BYTES = 8_000_000

#: kinds of bytes: 0 other symbols, 1 lower case, 2 upper case, 3 digits, 4 blank, 5 line end, 6 sentence marks, 7 pipes, 8 beyond ASCII
_KIND = np.zeros(256, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 8
for _c in b" \t":
    _KIND[_c] = 4
for _c in b"\r\n":
    _KIND[_c] = 5
for _c in b".,;:!?'\"()-":
    _KIND[_c] = 6
_KIND[ord("|")] = 7
KINDS = 9


def describe(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, and the number of passages of each text."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    n = np.array([max(1, -(-len(r) // PASSAGE)) for r in raw])
    flat = np.zeros(int(n.sum()) * PASSAGE, np.uint8)
    at = 0
    word_rows = []
    for r, k in zip(raw, n.tolist()):
        flat[at:at + len(r)] = np.frombuffer(r, np.uint8)
        at += k * PASSAGE
        for i in range(0, k * PASSAGE, PASSAGE):
            p = r[i:i + PASSAGE]
            w = p.split()
            m = len(w)
            if m:
                lines = p.split(b"\n")
                word_rows.append((m, len(set(w)) / m, sum(map(eq, w, w[1:])) / m, len(set(lines)) / len(lines)))
            else:
                word_rows.append((0, 1.0, 0.0, 1.0))
    grid = flat.reshape(-1, PASSAGE)
    kind = _KIND[grid]
    kind[grid == 0] = 255
    size = np.maximum((kind != 255).sum(axis=1), 1).astype(np.float64)
    counts = np.stack([(kind == k).sum(axis=1) for k in range(KINDS)], axis=1) / size[:, None]
    same = ((grid[:, 1:] == grid[:, :-1]) & (grid[:, 1:] != 0)).sum(axis=1) / size
    words = np.array(word_rows, dtype=np.float64)
    length = np.repeat(np.log1p(np.array([len(r) for r in raw], np.float64)) / 10, n)
    per_word = np.minimum(size / np.maximum(words[:, 0], 1) / 10, 5)
    return np.column_stack([np.sqrt(counts), np.sqrt(same), words[:, 1:], per_word, size / PASSAGE, length]), n


N_FEATURES = KINDS + 1 + 3 + 1 + 1 + 1


def _sum_by(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.concatenate([[0], np.cumsum(n)[:-1]]), axis=0)


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(p: dict, x: np.ndarray, n: np.ndarray) -> tuple:
    """Score of each bag; ``x`` has the passages of all bags in a row, ``n`` how many each has."""
    h = np.tanh(x @ p["W"] + p["b1"])
    t, g = np.tanh(h @ p["V"]), _sig(h @ p["U"])
    e = (t * g) @ p["w"]
    top = np.maximum.reduceat(e, np.concatenate([[0], np.cumsum(n)[:-1]]))
    u = np.exp(e - np.repeat(top, n))
    a = u / np.repeat(_sum_by(u, n), n)
    z = _sum_by(a[:, None] * h, n)
    return _sig(z @ p["c"] + p["b"]), (h, t, g, a, z)


def gradients(p: dict, x: np.ndarray, n: np.ndarray, y: np.ndarray) -> dict:
    """Gradients of the mean log loss."""
    score, (h, t, g, a, z) = forward(p, x, n)
    d = (score - y) / len(y)
    out = {"c": z.T @ d, "b": d.sum()}
    dz = np.repeat(d, n)[:, None] * p["c"]
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(_sum_by(a * da, n), n))
    out["w"] = (t * g).T @ de
    dtg = de[:, None] * p["w"]
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    out["V"], out["U"] = h.T @ dt, h.T @ dg
    dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
    return out | {"W": x.T @ dh, "b1": dh.sum(axis=0)}


def train_bags(bags: list[np.ndarray], y: np.ndarray, epochs: int = 40, batch: int = 64, rate: float = 0.01, seed: int = 7) -> dict:
    """Adam over shuffled batches of bags; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, dev = every.mean(axis=0), every.std(axis=0) + 1e-6
    f = every.shape[1]
    p = {"W": rng.normal(0, f ** -0.5, (f, HIDDEN)), "b1": np.zeros(HIDDEN), "V": rng.normal(0, 0.25, (HIDDEN, GATE)),
         "U": rng.normal(0, 0.25, (HIDDEN, GATE)), "w": rng.normal(0, 0.25, GATE), "c": rng.normal(0, 0.25, HIDDEN), "b": 0.0}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    bags = [np.clip((b - mean) / dev, -8, 8) for b in bags]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        lr = rate * (1 - epoch / epochs) + 1e-4
        for k in range(0, len(order), batch):
            part = order[k:k + batch]
            grad = gradients(p, np.concatenate([bags[i] for i in part]), np.array([len(bags[i]) for i in part]), y[part])
            step += 1
            for key, g in grad.items():
                g = g + 1e-4 * p[key]
                m[key] = 0.9 * m[key] + 0.1 * g
                v2[key] = 0.999 * v2[key] + 0.001 * g * g
                p[key] = p[key] - lr * (m[key] / (1 - 0.9 ** step)) / (np.sqrt(v2[key] / (1 - 0.999 ** step)) + 1e-8)
    return p | {"mean": mean, "dev": dev}


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN,
        id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model, or the share of label 1 if the rows have one label only."""
    train = training_texts(docs, labels, label, max_train, id_col, text_col)

    def rows(batches):
        for pdf in batches:
            x, n = describe(list(pdf["text"]))
            bags = np.split(x, np.cumsum(n)[:-1])
            yield pd.DataFrame({"id": pdf["id"], "y": pdf["y"], "x": [b.astype(np.float32).tobytes() for b in bags]})

    id_type = dict(train.dtypes)["id"]
    got = train.mapInPandas(rows, f"id {id_type}, y int, x binary").collect()
    got.sort(key=lambda r: (str(r["id"]), bytes(r["x"])))
    y = np.array([r["y"] for r in got], float)
    if len(set(y.tolist())) < 2:
        return {"base": float(y.mean()) if len(y) else 0.5}
    return train_bags([np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES).astype(np.float64) for r in got], y)


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score", keep_text: bool = True) -> DataFrame:
    """Add ``out``: the probability of label 1."""
    kept = [f for f in docs.schema.fields if f.name != out and (keep_text or f.name != text_col)]
    names = [f.name for f in kept]

    def scores(texts):
        if "base" in model:
            return np.full(len(texts), model["base"])
        x, n = describe(texts)
        return forward(model, np.clip((x - model["mean"]) / model["dev"], -8, 8), n)[0]

    def run(batches):
        for b in batches:
            column, values, part, size = b.column(text_col), [], [], 0
            for k in range(b.num_rows):
                part.append(column[k].as_py() or "")
                size += len(part[-1])
                if size >= BATCH_BYTES or k + 1 == b.num_rows:
                    values.append(scores(part))
                    part, size = [], 0
            value = np.concatenate(values) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(value, pa.float64())], [*names, out])

    return docs.select(*dict.fromkeys([*names, text_col])).mapInArrow(run, T.StructType(kept + [T.StructField(out, T.DoubleType())]))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model, keep_text=False)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
