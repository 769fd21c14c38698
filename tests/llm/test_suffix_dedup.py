"""Removal of long repeats against a table of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from sitelens.llm import suffix_dedup as S

SCHEMA = "doc_id bigint, text string"


def brute(rows, length):
    seen = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, d in data:
        seen.update(d[k:k + length] for k in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans, k = [], 0
        while (a := gone.find(1, k)) >= 0:
            k = gone.find(0, a)
            k = len(d) if k < 0 else k
            spans.append([a, k])
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n):
    """Copies, near copies, shared passages at odd places, periodic texts and short ones."""
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "do", "k\u00e4", "mo", "z") for b in ("ber", "lan", "\u4e2d", "nos", "t")]
    prose = lambda k: " ".join(rnd.choices(words, k=k))
    passages = [prose(k) for k in (6, 9, 12, 30)]
    texts = []
    for i in range(n):
        text = prose(rnd.randrange(60))
        for _ in range(rnd.randrange(3)):
            cut, part = rnd.randrange(len(text) + 1), rnd.choice(passages)
            text = text[:cut] + part[rnd.randrange(5):] + text[cut:]
        if texts and rnd.random() < 0.3:
            text = rnd.choice(texts)
            cut = rnd.randrange(len(text) + 1)
            text = text[:cut] + rnd.choice(["", "!", "more "]) + text[cut + rnd.randrange(3):]
        texts.append(text)
    texts += ["abc" * 60, "x" * 150, "x" * 39, "x" * 40, "", "\0" * 90, "q\0" * 50, passages[3] * 2]
    return [(i, t) for i, t in enumerate(texts)]


def got(spark, rows, partitions=4, **options):
    frame = S.removed_spans(spark.createDataFrame(rows, SCHEMA).repartition(partitions), **options)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, [list(s) for s in r.spans], r.kept_sha256)
                   for r in frame.collect()), key=repr)


def test_matches_all_windows(spark):
    rows = [*corpus(1, 120), (None, corpus(1, 120)[3][1]), (500, None), (500, "")]
    assert got(spark, rows, length=40) == brute(rows, 40)


def test_hot_cores_are_cut_and_buckets_split(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_WINDOWS", 300)
    rows = corpus(2, 90)
    passage = "a common passage that stands in very many of the documents, mostly whole"
    rows += [(1000 + i, f"{r[1][:30]}{i * 7919} {passage[i % 3:]} {i * 104729}{r[1][30:60]}") for i, r in enumerate(rows)]
    assert got(spark, rows, length=48, hot=3, batches=5) == brute(rows, 48)


def test_family_levels_grow_geometrically(spark):
    family = S.IndexFamily(spark, 40)
    rnd = random.Random(8)
    bodies = ["".join(rnd.choices("ab c", k=60)).encode() for _ in range(14)]
    bodies[9], bodies[13] = bodies[2][5:] + b"12345", bodies[12]
    sizes, found = [], set()
    for k in range(7):
        rows = [(0, i, i, 21, bytearray(bodies[i])) for i in (2 * k, 2 * k + 1)]
        hits = family.add(spark.createDataFrame(rows, "bucket int, e1 bigint, e2 bigint, n int, body binary"))
        found |= {(r.e1, r["first"], r["last"]) for r in hits.collect()}
        sizes.append([s for s, _ in family.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1], [4, 1, 1], [4, 2, 1]]
    assert found == {(2, 5, 20), (9, 0, 15), (12, 0, 20), (13, 0, 20)}
    family.close()
    assert family.levels == []


@pytest.mark.parametrize("size", [100, 1000])
def test_segments_cover_every_window_once_whatever_the_chunk(monkeypatch, size):
    text = " ".join(t for _, t in corpus(4, 20)).encode()[:5000]
    whole = {first + j: (core, delta - j) for core, first, n, delta in S.segments(text, 64) for j in range(n)}
    assert sorted(whole) == list(range(len(text) - 63))
    monkeypatch.setattr(S, "CHUNK", size)
    assert {first + j: (core, delta - j) for core, first, n, delta in S.segments(text, 64) for j in range(n)} == whole


def test_no_rows_and_other_columns(spark):
    assert got(spark, [], length=40) == []
    rows = [(1, "y" * 50, 3, "a"), (2, "z" * 10, 4, "b")]
    frame = spark.createDataFrame(rows, SCHEMA + ", first int, k1 string")
    assert {(r.doc_id, r.n_removed) for r in S.removed_spans(frame, length=40).collect()} == {(1, 50), (2, 0)}


def test_query_goes_by_400_bytes_not_by_words(spark, tmp_path):
    from sitelens.llm.queries import op13_suffix_dedup
    rnd = random.Random(13)
    word = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    passage = " ".join(word(4) for _ in range(80))     # 399 bytes
    sixty = " ".join(word(5) for _ in range(60))       # 359 bytes
    fill = lambda: word(300)
    line = word(450)
    rows = [(1, fill() + "1" + passage + "2" + fill()), (2, fill() + "3" + passage + "4" + fill()),
            (3, fill() + "5" + passage[::-1] + "6" + fill()), (4, fill() + "7" + passage[::-1] + "6" + fill()),
            (5, f"{fill()}\n{sixty}\n{fill()}"), (6, f"{fill()}\n{sixty}\n{fill()}"),
            (7, f"{line}\n{fill()}\n{line}"), (8, fill()), (9, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op13_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {i: (r.n_removed, r.n_spans) for i, r in found.items()} == {
        1: (0, 0), 2: (0, 0), 3: (400, 1), 4: (400, 1), 5: (0, 0), 6: (0, 0), 7: (900, 2), 8: (0, 0), 9: (0, 0)}
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.values()) == [
        (i, n, gone, len(spans), sha) for i, n, gone, spans, sha in brute(rows, 400)]
