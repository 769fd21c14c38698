"""Exact de-duplication against a plain grouping in Python."""

import hashlib
import random
import re

import numpy as np
import pytest

from sitelens.llm import exact_dedup as X
from sitelens.llm.common import materialize


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_rice_round_trip(n):
    rng = np.random.default_rng(n)
    low, width = X.owner_range(3, 7)
    values = np.unique(rng.integers(low, low + width, n, dtype=np.uint64))
    if len(values):
        k, code = X.rice_encode(values, low, width)
        assert (X.rice_decode(code, len(values), k, low) == values).all()


def test_owner_ranges_cover_the_space():
    assert X.owner_range(0, 5)[0] == 0
    assert sum(X.owner_range(o, 5)[1] for o in range(5)) == 1 << 64
    edges = np.array([0, (1 << 64) - 1], np.uint64)
    assert list(X.owner_of(edges, 5)) == [0, 4]


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        longest = max(len(t) for _, t in members)
        ids = [d for d, t in members if len(t) == longest and d is not None]
        keep = min(ids) if ids else None
        out += [(d, keep, len(members), d == keep, hashlib.sha256(norm.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=repr)


ROWS = ([(i, random.Random(i % 40).choice(["a b", "ab ", "é  x\t", "", None, "long " * 3000, "c\x0bd", "cd"]) )
         for i in range(60)] + [(100, "only once"), (101, " nbsp"), (102, "nbsp"), (None, "a b"), (103, "tie1"),
                                 (103, "tie1"), (104, "t ie1")])


@pytest.mark.parametrize("bits", [64, 2])
def test_groups_match_brute_force(spark, bits):
    docs = spark.createDataFrame([(d, t, "x") for d, t in ROWS], "doc_id bigint, text string, kept string").repartition(5)
    got = X.exact_groups(docs, fingerprint_bits=bits).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(ROWS)


def test_drop_copies_keeps_one_row_per_text(spark):
    rows = ROWS + [(None, "null ids"), (None, "null ids"), (None, "null  ids"), (100, "another text of this id")]
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows],
                                 "doc_id bigint, text string, kept_id string, digest int, row int").repartition(5)
    got = X.drop_copies(docs)
    assert got.columns == docs.columns
    best = {}
    for d, t in rows:
        key = "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")
        rank = (-len(t or ""), d is None, d or 0)
        best[key] = min(best.get(key, (rank, d)), (rank, d), key=lambda r: r[0])
    want = [(d, -rank[0], key) for key, (rank, d) in best.items()]
    have = [(r.doc_id, len(r.text or ""), "".join(c for c in (r.text or "") if c not in " \t\n\x0b\x0c\r")) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert X.exact_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_rows_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def planned(df, name, by=None):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, name, by)

    monkeypatch.setattr(X, "materialize", planned)
    rows = [(i, f"text {i % 7}") for i in range(20)]
    got = X.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in brute(rows)}
    assert "SortMergeJoin" in plans["dedup-marked"] and "Broadcast" not in plans["dedup-marked"]
