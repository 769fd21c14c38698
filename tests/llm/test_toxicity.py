"""Toxicity: held-out accuracy on planted words, label-model recovery, edge cases."""

import random
import zlib

import numpy as np
import pytest

from sitelens.llm import toxicity as T


def corpus(n=600):
    rnd = random.Random(2)
    words = [f"{a}{b}" for a in "ba do ka li mo ne pu ra si tu".split() for b in "ber lan mit nos pel rok tas".split()]
    bad = ["vilko", "vilkan", "vilkur", "grumzel", "snarp"]
    docs, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randrange(20, 80))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(bad) + rnd.choice(["", ",", "!"]))
        docs.append((i, " ".join(text).capitalize(), "toxic"))
        if i % 5:
            labels.append((i, int(toxic)))
    # copies of one toxic text must not make its other words suspicious
    docs += [(n + k, docs[0][1], "x") for k in range(40)]
    labels += [(n + k, 1) for k in range(40)]
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs + [(9000, None, ""), (9001, "", ""), (None, "vilko snarp", ""), (3, docs[3][1], "")],
                              "doc_id bigint, text string, score string").repartition(4)
    lab = spark.createDataFrame(labels + [(7, None), (None, 1), (6, 0)], "doc_id bigint, toxic int")
    return docs, T.toxicity(d, lab).collect(), d, lab


def test_held_out_documents_are_told_apart(scored):
    docs, rows, *_ = scored
    assert len(rows) == len(docs) + 4
    truth = {i: int(i % 6 == 0 or i >= 600) for i, *_ in docs}
    wrong = [r for r in rows if r.doc_id in truth and r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 0.02 * len(rows)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert all(r.predicted == 0 for r in rows if r.doc_id in (9000, 9001))


def test_the_stage_keeps_clean_rows(scored):
    docs, rows, d, lab = scored
    kept = T.drop_toxic(d, lab)
    assert kept.columns == d.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in rows if not r.predicted)


def test_label_model_finds_rates_and_discounts_copies(spark):
    rng = np.random.default_rng(0)
    y = rng.random(20000) < 0.2
    on1, on0 = np.array([0.8, 0.7, 0.6, 0.5]), np.array([0.05, 0.1, 0.02, 0.1])
    x = rng.random((20000, 4)) < np.where(y[:, None], on1, on0)
    x = np.hstack([x, x[:, :1]])                      # a voter that repeats the first
    masks, n = np.unique((x << np.arange(5)).sum(axis=1), return_counts=True)
    patterns = spark.createDataFrame([(int(m), int(k)) for m, k in zip(masks, n, strict=True)], "mask bigint, n bigint")
    start = (0.3, np.full(5, 0.6), np.full(5, 0.2))
    prior, got1, got0, shrink = T.fit_label_model(patterns, start, rounds=25)
    assert abs(prior - 0.2) < 0.05
    assert np.abs(got1[1:4] - on1[1:]).max() < 0.1 and np.abs(got0[1:4] - on0[1:]).max() < 0.05
    assert shrink[0] < 0.7 and shrink[4] < 0.7 and shrink[1:4].min() > 0.7


def test_without_labels_or_rows(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [tuple(r) for r in T.toxicity(d, none).collect()] == [(1, False, 0.0, 0)]
    assert T.toxicity(d.limit(0), none).count() == 0
    only = spark.createDataFrame([(2, 1), (3, 1)], "doc_id bigint, toxic int")
    assert T.toxicity(d, only).count() == 1
