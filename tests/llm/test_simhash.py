"""SimHash near-duplicates against comparing every two fingerprints."""

import random
import re

import numpy as np
import xxhash

from sitelens.llm import simhash as S
from sitelens.llm.common import materialize
from sitelens.llm.components import connected_components


def plain_fingerprint(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, d):
    parent = {f: f for f in fps}
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if bin(a ^ b).count("1") <= d:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    low = {}
    for i, f in zip(ids, fps, strict=True):
        if i is not None:
            low[root(f)] = min(low.get(root(f), i), i)
    return {(i, f"{f:016x}", low.get(root(f))) for i, f in zip(ids, fps, strict=True)}


TEXTS = ["", None, " \t\n", "One", "one", "ÉTÉ a", "été a", "a b c", "A  b\x0bC", "a b c a b c a b c " * 900, " x y"]


def test_fingerprint_definition():
    rnd = random.Random(3)
    texts = TEXTS + [" ".join(rnd.choices("the of And a b c É".split(), k=rnd.randrange(1, 60))) for _ in range(40)]
    for t in texts:
        assert S.fingerprint(t, 3) == plain_fingerprint(t, 3)


def test_documents_match_brute_force(spark):
    rnd = random.Random(5)
    base = [" ".join(rnd.choices([f"w{i}" for i in range(50)], k=80)) for _ in range(30)]
    texts = list(TEXTS)
    for t in base:
        texts.append(t)
        for _ in range(3):
            words = t.split()
            words[rnd.randrange(80)] = "changed"
            texts.append(" ".join(words))
    ids = [None if i == 2 else i for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "z") for i, t in zip(ids, texts, strict=True)],
                                 "doc_id bigint, text string, fp string").repartition(4)
    got = {tuple(r) for r in S.near_duplicates(docs).collect()}
    assert got == plain_components(ids, [plain_fingerprint(t, 3) for t in texts], 3)
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got})


def test_links_lose_no_pair(spark):
    rnd = np.random.default_rng(1)
    centre = rnd.integers(0, 1 << 63, 20, dtype=np.int64)
    fps = {int(c) for c in centre} | {0, -1}
    for c in list(fps):
        for _ in range(12):
            x = c
            for b in rnd.choice(64, rnd.integers(1, 5), replace=False):
                x ^= S.mask_of([int(b)])
            fps.add(x)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint").repartition(3)
    want = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    for cost in (S.CANDIDATE_COST, 1e-6, 1e6):
        S.CANDIDATE_COST, old = cost, S.CANDIDATE_COST
        try:
            assert {tuple(r) for r in S.links(df, 3).collect()} == want
        finally:
            S.CANDIDATE_COST = old


def test_probes_are_not_broadcast(spark):
    # 40 stored fingerprints are a small table to Spark, their probes are 66 times as many
    fps = {int(x) for x in np.random.default_rng(2).integers(0, 1 << 63, 40, dtype=np.int64)}
    fps |= {f ^ 0b101 for f in fps}
    found = S.links(materialize(spark.createDataFrame([(f,) for f in fps], "fp bigint"), "test-fps"), 3)
    assert {frozenset(r) for r in found.collect()} == {frozenset((f, f ^ 0b101)) for f in fps}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_thresholds_sum_to_the_pigeonhole_bound():
    share = np.full(17, 1 / 17)
    _, t = S.allocate(1000, [(16, share), (16, share / 50), (16, share), (16, share)], 3)
    assert sum(t) == 0 and len(t) == 4


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 499), (7, 7)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {500: 499, 499: 499}


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_keep_first_keeps_one_row_per_component(spark):
    texts = [f"{w} one two three four five six seven eight nine ten" for w in ("a", "b")] + ["", "other words stand here now"]
    rows = [(3, texts[0]), (None, texts[0]), (None, texts[2]), (None, texts[2]), (5, texts[3]), (3, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows],
                                 "doc_id bigint, text string, kept_id string, fp int, component string").repartition(3)
    got = S.keep_first(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(3, texts[0]), (None, texts[2]), (3, texts[3])], key=repr)
