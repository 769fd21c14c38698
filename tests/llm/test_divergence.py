"""The divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sitelens.llm import divergence as D

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, min_docs=10, top=10):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = plain_terms(text)
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = {s: c for (g, s), c in groups.items() if g == lang}
        whole = sum(own.values(), Counter())

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}
        far = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            pairs = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, far(p[s][t], q[t])) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda r: (-r[1], r[0].encode()))[:most]
                out |= {(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(ranked)}
    return out


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ba", "do", "K\u00e4", "\u00e9t\u00e9", "mo") for b in ("ber", "lan", "NOS", "\u4e2d\u6587", "x" * 9, "y" * 30, "z" * 80)]
    for i in range(n):
        own = rnd.sample(words, 20)
        yield (i % 50, " ".join(rnd.choices(own, k=rnd.randrange(40))) + rnd.choice([".", "7a", "\x00b", "{c}"]),
               rnd.choice(["en", "de", None]), rnd.choice(["s1", "s1", "s1", "s2", "s3", "\u00e9", None]))


def rows_of(frame):
    return {tuple(r) for r in frame.collect()}


@pytest.mark.parametrize("cell,tile", [(4096, 64), (5, 2)])
def test_matches_plain_counting(spark, cell, tile):
    rows = [*corpus(3, 240), (1, None, "fr", "s1"), (2, "", "fr", "s2"), (3, "one only", "it", "s1")]
    got = D.divergence(spark.createDataFrame(rows, SCHEMA).repartition(5), cell_terms=cell, tile=tile)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows_of(got) == brute(rows)


def test_radix_order_is_stable_and_ascending():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 3, 500, dtype=np.uint64) << np.uint64(61), rng.integers(0, 2**64, 500, dtype=np.uint64)]
    words[1][::3] = words[1][0]
    order = D.radix_order(words)
    assert order.tolist() == sorted(range(500), key=lambda i: (words[0][i], words[1][i], i))


def test_a_long_text_is_counted_in_parts_as_one_document(monkeypatch):
    monkeypatch.setattr(D, "SLICE", 50)
    import pyarrow as pa
    text = " ".join(w for _, t, _, _ in corpus(5, 30) for w in [t]) + " " + "q" * 200 + " end end"
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (["en"] * 2, ["s"] * 2, [text, "end"])], names=["l", "s", "t"])
    total = Counter()
    for out in D.count_terms([batch]):
        for r in out.to_pylist():
            key = r["tail"] or b"".join((w % 2**64).to_bytes(8, "big") for w in (r["hi"], r["lo"])).rstrip(b"\0")
            total[key.decode()] += r["n"]
            assert r["docs"] == (2 if key == b"end" else 1)
    assert total == Counter(plain_terms(text)) + Counter(["end"])


def test_no_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert D.divergence(empty).count() == 0
    rows = [(i, "same words here", "en", f"s{i % 2}", 5, "x") for i in range(20)]
    frame = spark.createDataFrame(rows, SCHEMA + ", p int, item string")
    assert rows_of(D.divergence(frame)) == brute([r[:4] for r in rows])
