"""Toxicity's EM and score, and the language of a text, against plain loops over rows."""

import math

import numpy as np
import pytest

from sitelens.llm import language as L
from sitelens.llm import toxicity as T


def sigmoid(z):
    return 1 / (1 + math.exp(-min(30, max(-30, z))))


def plain_em(rows, prior, on1, on0, rounds):
    """EM over single rows of votes, with the discount of voters that fire together."""
    k = len(on1)
    shrink = [1.0] * k
    for _ in range(rounds):
        posts = []
        for votes in rows:
            z = math.log(prior / (1 - prior))
            for j, v in enumerate(votes):
                z += shrink[j] * (math.log(on1[j] / on0[j]) if v else math.log((1 - on1[j]) / (1 - on0[j])))
            posts.append(sigmoid(z))
        size = [sum(1 - p for p in posts), sum(posts)]
        prior = min(0.9, max(1e-4, size[1] / sum(size)))
        fired = [[sum((p if y else 1 - p) for p, v in zip(posts, rows, strict=True) if v[j]) for j in range(k)] for y in (0, 1)]
        both = [[[sum((p if y else 1 - p) for p, v in zip(posts, rows, strict=True) if v[i] and v[j])
                  for j in range(k)] for i in range(k)] for y in (0, 1)]
        on0, on1 = ([min(1 - 1e-5, max(1e-5, (fired[y][j] + 0.05) / (size[y] + 0.1))) for j in range(k)] for y in (0, 1))
        shrink = []
        for i in range(k):
            total = 0.0
            for j in range(k):
                rho = [(both[y][i][j] / size[y] - on[i] * on[j]) / math.sqrt(on[i] * (1 - on[i]) * on[j] * (1 - on[j]))
                       for y, on in ((0, on0), (1, on1))]
                strongest = max(min(1, max(0, r)) for r in rho)
                total += strongest if i != j and strongest >= 0.1 else 0
            shrink.append(1 / (1 + total))
    return prior, on1, on0, shrink


def test_label_model_equals_plain_em(spark):
    rng = np.random.default_rng(4)
    y = rng.random(200) < 0.3
    x = rng.random((200, 4)) < np.where(y[:, None], [0.7, 0.6, 0.5, 0.8], [0.1, 0.05, 0.1, 0.2])
    x = np.hstack([x, x[:, 1:2]])
    masks, n = np.unique((x << np.arange(5)).sum(axis=1), return_counts=True)
    patterns = spark.createDataFrame([(int(m), int(c)) for m, c in zip(masks, n, strict=True)], "mask bigint, n bigint")
    start = (0.25, [0.5] * 5, [0.15] * 5)
    got = T.fit_label_model(patterns, (start[0], np.array(start[1]), np.array(start[2])), rounds=6)
    want = plain_em([[bool(v) for v in row] for row in x], *start, rounds=6)
    for a, b in zip(got, want, strict=True):
        assert np.allclose(a, b, atol=1e-9)


def plain_score(model, text):
    """The classifier on a text, feature by feature."""
    words = text.lower().split()
    hit = {w for w in set(words) if any(t in model.terms for t in T._terms_of(w.strip(T.STRIP)))}
    z = model.bias
    for term, place in model.terms.items():
        if any(term in T._terms_of(w.strip(T.STRIP)) for w in words):
            z += model.weights[place]
    stripped = {w.strip(T.STRIP) for w in hit}
    count = len([w for w in set(words) if w.strip(T.STRIP) in stripped])
    on = [text.isupper() and sum("A" <= c <= "Z" for c in text) > 20, text.count("!!") >= 3,
          len(words) > 20 and len(set(words)) < len(words) / 4, count >= 1, count >= 2, bool(words) and count * 100 >= len(words)]
    return sigmoid(z + sum(w for w, v in zip(model.weights[len(model.terms):], on, strict=True) if v))


def test_score_equals_plain_features(spark):
    rng = np.random.default_rng(5)
    terms = ["vilk", "=snarp", "grumz", "=ug"]
    model = T.Model({t: i for i, t in enumerate(terms)}, frozenset(t.lstrip("=")[:T.PREFIXES[0]] for t in terms), 0.1,
                    rng.normal(size=len(terms) + len(T.PATTERNS)), -0.3)
    words = ["vilkor", "VILKAN,", "snarp!", "snarps", "grumzel", "ug", "a", "be", "calm", "DOG", "word!!", "(snarp)"]
    texts = ["", "   ", "A" * 30, "é" * 40, "vilkan"] + [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(200)]
    texts += [t.upper() for t in texts[-20:]]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.s for r in rows.select("i", T.scorer(model)("text").alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(model, t), abs=1e-9), t


def plain_language(net, text):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    data, shares, weights = text.encode(), [], []
    for at in range(0, len(data), L.WINDOW):
        window = data[at:at + L.WINDOW]
        weights.append(len(window))
        padded = window + bytes(L.WINDOW - len(window))
        tops = []
        for w in net.filters:
            sums = [sum(net.embedding[padded[p + k]].astype(float) @ w[k] for k in range(len(w)))
                    for p in range(L.WINDOW - len(w) + 1)]
            tops.append(np.max(sums, axis=0))
        z = np.maximum(np.concatenate(tops) + net.bias, 0) @ net.out + net.out_bias
        shares.append(np.exp(z - z.max()) / np.exp(z - z.max()).sum())
    mean = sum(s * n for s, n in zip(shares, weights, strict=True)) / sum(weights)
    return net.languages[int(mean.argmax())], float(mean.max())


def test_language_of_whole_texts_equals_plain_windows():
    rng = np.random.default_rng(6)
    x = rng.integers(97, 123, (64, L.WINDOW), dtype=np.uint8)
    y = rng.integers(0, 3, 64)
    net = L.train(x + (y[:, None] * 5).astype(np.uint8), y, ["aa", "bb", "cc"])
    texts = ["", "12 !?", "é", "a" * L.WINDOW, "b" * (L.WINDOW + 1), " 9 " * 100 + "z", "ж" * 300]
    texts += ["".join(rng.choice(list("abcxyzé 1"), int(n))) for n in rng.integers(1, 900, 12)]
    for t, (lang, score) in zip(texts, net.predict(texts), strict=True):
        want = plain_language(net, t)
        assert lang == want[0] and score == pytest.approx(want[1], abs=1e-4), t
