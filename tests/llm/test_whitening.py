"""Whitening by block matrices against numpy on one array."""

import random

import numpy as np
import pytest

from sitelens.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, components):
    """(id, n, deviation, whitened, explained) a row, whitened up to signs of the columns."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(float(np.float32(c)) * 64)) + 1_000_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    dev = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > e[0] * len(e) * np.finfo(float).eps).sum()))
    return [i for i, _ in good], n, dev, centred @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def wide(found, k):
    """Rows by (id, deviation): ids may repeat."""
    by = {}
    for r in found:
        by.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r.whitened)
    return {key: sorted(zip(*[row[c] for c in range(1, k + 1)], strict=True)) for key, row in by.items()}


@pytest.mark.parametrize("partitions,block,panel", [(3, 512, 16_384), (2, 16, 2)])
def test_matches_numpy(spark, partitions, block, panel):
    """Small blocks and panels give several of each."""
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(3 * j, 1 + j) for j in range(6)]) for i in range(60)]
    rows += [(7, rows[3][1]), (None, rows[5][1]), (None, None), (70, [1.0] * 5 + [float("nan")]),
             (71, [float("inf")] + [1.0] * 5), (72, [None] + [1.0] * 5)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(partitions)
    found = W.whiten(table, 4, block, panel).collect()
    ids, n, dev, expected, explained = brute(rows, 4)
    assert len(found) == 4 * len(ids) and {r.n for r in found} == {n}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-10
    got = wide(found, 4)
    first = {(i, d): w for i, d, w in zip(ids, dev, expected, strict=True)}
    assert set(got) == set(first)
    key = (0, dev[0])
    signs = np.sign(np.array(got[key][0]) * first[key])
    for key, w in first.items():
        for row in got[key]:
            assert np.allclose(np.array(row) * signs, w, atol=1e-9)
    for r in found:
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)


def test_few_equal_and_no_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert W.whiten(make([])).count() == 0
    assert W.whiten(make([(1, None, 0), (2, [float("nan")], 0)])).count() == 0
    assert W.whiten(make([(1, [1.0, 2.0], 0)])).count() == 0          # no variance
    assert W.whiten(make([(1, [1.0, 2.0], 0)] * 5)).count() == 0
    assert W.whiten(make([(1, [], 0)])).count() == 0
    two = W.whiten(make([(1, [0.0, 1.0, 5.0], 0), (2, [1.0, 3.0, 5.0], 0)])).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_odd_lengths_huge_entries_and_other_columns(spark):
    rows = [(i, [float(i), float(i * i % 7)], 9, "x") for i in range(9)] + [(50, [1.0], 9, "x")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, component int, x string")
    found = W.whiten(table).collect()
    assert {r.vec_id for r in found} == set(range(9)) and {r.n for r in found} == {9}
    huge = spark.createDataFrame([(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0), (3, [0.0, 2.0], 0)],
                                 "vec_id bigint, embedding array<double>, label int")
    edge = 1 << 40
    x = [(edge + 1_000_000, 1_000_000), (-edge + 1_000_000, 1_000_064), (1_000_000, 1_000_128)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    got = {r.vec_id: int(r.deviation) for r in W.whiten(huge).collect()}
    assert got == {i + 1: sum((3 * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for i, r in enumerate(x)}
