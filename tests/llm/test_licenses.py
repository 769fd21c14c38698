"""License scans against a plain comparison of every unit with every template."""

import random
import re

from sitelens.llm import licenses as L


def bigrams(unit):
    words = [w for w in re.split(L.SEPARATORS, unit.lower()) if w]
    return {(a, b) for a, b in zip(words, words[1:], strict=False)}


def brute(text, templates):
    text = text or ""
    pieces = [text, *re.split(r"\n[ \t\r]*\n", text)]
    for line in text.split("\n"):
        pieces += [line, *re.split(L.SENTENCE_END, line)]
    found = {}
    for name, body in templates.items():
        t = bigrams(body)
        scores = [2 * len(u & t) / (len(u) + len(t)) for u in map(bigrams, pieces) if u]
        if scores and max(scores) >= 0.8:
            found[name] = max(scores)
    return sorted(found.items())


def case():
    rnd = random.Random(5)
    rows = [(0, None), (1, ""), (2, "mit"), (3, "the\n\n\n"), (4, "Released under the MIT License " * 200)]
    for i, (name, body) in enumerate(L.TEMPLATES.items()):
        words = body.split()
        rows.append((10 + i, body))
        rows.append((100 + i, f"Some prose before it. {body} And some prose behind.\nMore."))
        rows.append((200 + i, "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9)) + "\n\nother block"))
        for k in range(6):
            changed = [w if rnd.random() > 0.04 * k else "changed" for w in words]
            rows.append((1000 + 10 * i + k, " ".join(changed).upper() if k % 2 else " ".join(changed)))
    rows += [(10, rows[5][1]), (None, "Licensed under CC BY-NC 4.0."), (5, "LICENSED UNDER CC BY NC 4 0")]
    return rows


def test_scores_match_brute_force(spark):
    rows = case()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, units string").repartition(4)
    got = sorted(((r.doc_id, [tuple(m) for m in r.licenses]) for r in L.licenses(docs).collect()), key=repr)
    want = sorted(((d, brute(t, L.TEMPLATES)) for d, t in rows), key=repr)
    assert [(d, [n for n, _ in m]) for d, m in got] == [(d, [n for n, _ in m]) for d, m in want]
    for (_, a), (_, b) in zip(got, want, strict=True):
        assert all(abs(x - y) < 1e-9 for (_, x), (_, y) in zip(a, b, strict=True))


def test_needed_words_are_needed():
    for body in L.TEMPLATES.values():
        grams = L.template_bigrams(body)
        words = L.needed_words(grams, 0.8)
        left = [b for b in grams if not words & set(b.split())]
        assert len(left) < 0.8 / 1.2 * len(grams)


def test_native_and_without_shuffle(spark):
    docs = spark.createDataFrame(case(), "doc_id bigint, text string")
    plan = L.licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert L.licenses(docs.limit(0)).count() == 0
    assert all(r.licenses == [] for r in L.licenses(docs, templates={}).collect())
