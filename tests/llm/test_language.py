"""Language identification: held-out accuracy, the folded network, edge cases."""

import random
import zlib

import numpy as np

from sitelens.llm import language as L


def corpus(n=360):
    rnd = random.Random(7)
    parts = {"aa": "ba ka lo mu ti".split(), "bb": "sch eu ung ö kr".split(), "cc": "що ра ки не".split()}
    out = []
    for i in range(n):
        lang = rnd.choice(sorted(parts))
        out.append((i, " ".join("".join(rnd.choices(parts[lang], k=3)) for _ in range(rnd.randrange(4, 200))),
                    None if i % 50 == 7 else lang))
    return out


def test_held_out_accuracy_and_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows + [(9000, None, "aa"), (9001, "", "aa"), (9002, " 123 !? ", "bb"),
                                         (None, rows[0][1], "zz"), (0, rows[0][1], rows[0][2])],
                                 "doc_id bigint, text string, lang string").repartition(4)
    got = L.identify(docs).collect()
    assert len(got) == len(rows) + 5
    lang = {i: v for i, _, v in rows if v}
    held = [r for r in got if r.held_out and r.doc_id in lang]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held) > 50
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert (r.lang_pred == "und") == (r.doc_id in (9000, 9001, 9002))
    assert "zz" not in {r.lang_pred for r in got}


def test_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    net = L.train(rng.integers(0, 256, (32, L.WINDOW), dtype=np.uint8), rng.integers(0, 2, 32), ["a", "b"])
    x = rng.integers(0, 256, (5, L.WINDOW), dtype=np.uint8)
    e, want = net.embedding[x], []
    for w in net.filters:
        n = L.WINDOW - len(w) + 1
        want.append(sum(e[:, k:k + n] @ w[k] for k in range(len(w))).max(axis=1))
    assert np.allclose(net.hidden(x), np.hstack(want) + net.bias, atol=1e-4)


def test_windows_cover_the_text():
    text = "é" * 1000
    assert L.windows_of(text).tobytes().rstrip(b"\0") == text.encode()


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in L.identify(docs).collect()] == [(1, False, "und", 0.0)]
    assert L.identify(docs.limit(0)).count() == 0
