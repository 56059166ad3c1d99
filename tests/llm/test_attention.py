"""The quality classifier's attention and gradients against plain loops and finite differences."""

import math

import numpy as np

from corpusmill.llm import quality


def model(rng, f):
    h, g = quality.HIDDEN, quality.GATE
    return {"W": rng.normal(size=(f, h)), "b1": rng.normal(size=h), "V": rng.normal(size=(h, g)), "U": rng.normal(size=(h, g)),
            "w": rng.normal(size=g), "c": rng.normal(size=h), "b": 0.3}


def plain(p, bag):
    """Score of one bag, passage by passage."""
    hidden, energy = [], []
    for x in bag:
        h = [math.tanh(sum(x[i] * p["W"][i][j] for i in range(len(x))) + p["b1"][j]) for j in range(len(p["b1"]))]
        e = 0.0
        for k in range(len(p["w"])):
            v = sum(h[j] * p["V"][j][k] for j in range(len(h)))
            u = sum(h[j] * p["U"][j][k] for j in range(len(h)))
            e += p["w"][k] * math.tanh(v) / (1 + math.exp(-u))
        hidden.append(h)
        energy.append(e)
    weight = [math.exp(e) for e in energy]
    z = [sum(a * h[j] for a, h in zip(weight, hidden)) / sum(weight) for j in range(len(p["c"]))]
    return 1 / (1 + math.exp(-sum(c * v for c, v in zip(p["c"], z)) - p["b"]))


def test_score_is_the_plain_loop():
    rng = np.random.default_rng(1)
    p = model(rng, 4)
    bags = [rng.normal(size=(n, 4)) for n in (1, 7, 2, 130, 1)]
    got, _ = quality.forward(p, np.concatenate(bags), np.array([len(b) for b in bags]))
    assert np.allclose(got, [plain(p, b) for b in bags])


def test_gradients_are_finite_differences():
    rng = np.random.default_rng(2)
    p = model(rng, 3)
    n, y = np.array([3, 1, 5]), np.array([1.0, 0.0, 1.0])
    x = rng.normal(size=(int(n.sum()), 3))

    def loss():
        s = quality.forward(p, x, n)[0]
        return float(-(y * np.log(s) + (1 - y) * np.log(1 - s)).mean())

    grad = quality.gradients(p, x, n, y)
    for key in grad:
        p[key] = np.array(p[key], float)
        for at in np.ndindex(p[key].shape):
            old = float(p[key][at])
            p[key][at] = old + 1e-5
            up = loss()
            p[key][at] = old - 1e-5
            down = loss()
            p[key][at] = old
            assert abs((up - down) / 2e-5 - np.asarray(grad[key])[at]) < 1e-6, key


def test_all_passages_of_a_long_text_are_described():
    x, n = quality.describe(["word " * 20_000, ""])
    assert n.tolist() == [-(-100_000 // quality.PASSAGE), 1] and len(x) == n.sum()
