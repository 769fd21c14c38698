"""Notices that are in no unit of their own: wrapped, commented, inside longer text."""

import math
import random
import re

from sitelens.llm import licenses as L


def words(text):
    text = re.sub(r"(?im)^[\W_]*?(?:rem|dnl)(?=[ \t])", " ", text or "")
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def windows(text, templates, threshold=0.8):
    """Every template against all windows of its length that begin at one of its bigrams."""
    w, found = words(text), {}
    grams = list(zip(w, w[1:], strict=False))
    for name, body in templates.items():
        n = len(words(body)) - 1
        t = set(zip(words(body), words(body)[1:], strict=False))
        starts = {max(0, min(i, len(grams) - n)) for i, g in enumerate(grams) if g in t}
        cut = [set(grams[s:s + n]) for s in starts]
        score = max((2 * len(u & t) / (len(u) + len(t)) for u in cut), default=0)
        if score >= threshold:
            found[name] = score
    return found


def wrap(text, width, leader):
    w = text.split()
    return "\n".join(leader + " ".join(w[k:k + width]) for k in range(0, len(w), width))


PROSE = " ".join(f"{a}{b}" for a in "ba do ka li mo ne pu ra".split() for b in "ber lan mit nos pel rok tas the of".split())


def case():
    rnd = random.Random(8)
    rows = [(0, None, set()), (1, "", set()), (2, PROSE, set())]
    for i, (name, body) in enumerate(L.TEMPLATES.items()):
        for k, leader in enumerate(["# ", " * ", "// ", "", "REM ", "dnl ", "│ "]):
            inside = wrap(f"{PROSE} {body} {PROSE}", 7, leader)
            rows.append((100 * (i + 1) + k, inside, {name}))
        for k in range(6):
            changed = [w if rnd.random() > 0.05 * k else "changed" for w in body.split()]
            rows.append((100 * (i + 1) + 50 + k, wrap(f"{PROSE} {' '.join(changed)} {PROSE}", 9, "; "), set()))
    return rows


def found(spark, rows, **kw):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    return {r.doc_id: {m.license: m.score for m in r.licenses} for r in L.licenses(docs, windowed=True, **kw).collect()}


def test_wrapped_notices_are_found(spark):
    got = found(spark, case())
    assert len(got) == len(case())
    for doc_id, text, names in case():
        assert names <= set(got[doc_id]), (doc_id, text)
        assert all(got[doc_id][n] == 1.0 for n in names)
        for name, score in windows(text, L.TEMPLATES).items():
            assert got[doc_id][name] >= score - 1e-9
        # units here are single lines and the whole text, which is longer than any template
        assert set(got[doc_id]) == set(windows(text, L.TEMPLATES))


def test_the_reviewed_texts(spark):
    gpl = L.TEMPLATES["gpl-header"] + " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."
    mit = "Copyright (c) 2020 A. Person\n\n" + L.TEMPLATES["mit-grant"] + "\n\nTHE SOFTWARE IS PROVIDED AS IS."
    mit = "/*\n" + "\n *\n".join(wrap(p, 8, " * ") for p in mit.split("\n\n")) + "\n */\nint main() { return 0; }"
    work = f"{PROSE}. This work is licensed under\nthe GNU General Public License, version 3. {PROSE}"
    rows = [(1, wrap(gpl, 10, "# ") + "\nimport os\n" + PROSE), (2, mit + PROSE), (3, work),
            (4, "This software is released under the MIT License, as is all of it.")]
    got = found(spark, rows)
    assert "gpl-header" in got[1] and "mit-grant" in got[2] and "gpl-3.0" in got[3] and "mit" in got[4]


def test_units_stay_and_scores_are_the_best(spark):
    docs = [(1, "x " + L.TEMPLATES["isc-grant"]), (2, L.TEMPLATES["mpl-2.0"]), (3, "Released under the MIT License " * 50)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    plain = {r.doc_id: {m.license: m.score for m in r.licenses} for r in L.licenses(frame).collect()}
    got = found(spark, docs)
    for doc_id, known in plain.items():
        assert known and all(got[doc_id][n] >= s for n, s in known.items())
    assert got[1]["isc-grant"] == got[3]["mit"] == 1.0


def test_least_shared_is_reached_by_every_match():
    for n in range(1, 300):
        least = L.least_shared(n, 0.8)
        assert 2 * (least - 1) / (least - 1 + n) < 0.8 <= 2 * least / (least + n) + 1e-9
        assert least == math.ceil(0.8 / 1.2 * n - 1e-9)


def test_native_and_without_shuffle(spark):
    docs = spark.createDataFrame([r[:2] for r in case()], "doc_id bigint, text string")
    plan = L.licenses(docs, windowed=True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert L.licenses(docs.limit(0), windowed=True).count() == 0
