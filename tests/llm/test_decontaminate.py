"""Decontamination against a plain scan of every window."""

import random
import re

from sitelens.llm import decontaminate as D


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        doc, hit, met = words(text), set(), set()
        for item_id, body in items:
            item = words(body)
            n = min(size, len(item))
            for s in range(len(item) - n + 1 if n else 0):
                for p in range(len(doc) - n + 1):
                    if doc[p:p + n] == item[s:s + n]:
                        hit |= set(range(p, p + n))
                        met.add(item_id)
        out.append((doc_id, len(doc), len(hit), sorted(str(i) for i in met if i is not None)))
    return sorted(out, key=repr)


def case():
    rnd = random.Random(11)
    vocab = "alpha Beta gamma the of ÉTÉ été and a1 x".split() + [f"rare{i}" for i in range(30)]
    body = lambda n: " ".join(rnd.choices(vocab, k=n))
    items = [(i, body(rnd.randrange(11, 25))) for i in range(12)]
    items += [(20, "the of"), (21, "x"), (22, ""), (23, None), (24, "the the the the the the the the the the the"),
              (3, "second text of item three with some more words in it here"), (None, body(12)), (20, "the of")]
    docs = [(i, body(rnd.randrange(0, 60))) for i in range(25)]
    for i, (_, t) in enumerate(items):
        docs.append((100 + i, f"{body(7)}, {t}! {body(5)}"))
        docs.append((200 + i, " ".join((t or "").split()[:10])))
        docs.append((300 + i, " ".join((t or "").upper().split()[1:])))
    docs += [(400, None), (401, ""), (402, "the " * 3000), (403, items[0][1]), (403, items[0][1]), (403, "other"),
             (None, items[1][1])]
    return docs, items


def test_hits_match_brute_force(spark):
    docs, items = case()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id bigint, text string, item_id string").repartition(4)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, n_words int")
    got = D.contamination(d, b).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, sorted(r.item_ids)) for r in got], key=repr) == brute(docs, items)
    assert all(r.item_ids == sorted(r.item_ids) for r in got)
    kept = D.drop_contaminated(d, b)
    assert kept.columns == d.columns
    # each row by its own text: the row (403, "other") stays though two rows of its id go
    clean = [r for r in docs if not brute([r], items)[0][2]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_proximity(spark):
    d = spark.createDataFrame([(1, "zig filler words zag"), (2, "zig one two three four five six seven eight zag"),
                               (3, "zig zag")], "doc_id bigint, text string")
    b = spark.createDataFrame([(7, "zig zag")], "item_id bigint, text string")
    got = {r.doc_id: (r.n_hit, r.n_near) for r in D.contamination(d, b).collect()}
    assert got == {1: (0, 1), 2: (0, 0), 3: (2, 0)}


def test_no_python_in_the_plan(spark):
    docs, items = case()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    plan = D.contamination(d, spark.createDataFrame(items, "item_id bigint, text string"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    b = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contamination(d, b).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert [tuple(r)[:3] for r in D.contamination(one, b).collect()] == [(1, 2, 0)]


def test_a_clean_row_with_the_id_of_a_hit_stays(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"x {item} y"), (1, "clean"), (None, item), (None, "clean too"), (2, None)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, hit_id string, key int")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = D.drop_contaminated(docs, bench)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(1, "clean"), (None, "clean too"), (2, None)], key=repr)


def test_a_passage_that_one_text_repeats_many_times(spark):
    rnd = random.Random(5)
    item = [f"w{rnd.randrange(400)}" for _ in range(2000)]
    passage = " ".join(item[700:710])
    docs = spark.createDataFrame([(1, f"{passage}. " * 20000), (2, " ".join(item[3:12])), (3, " ".join(item))],
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, " ".join(item)), (10, passage)], "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in D.contamination(docs, bench).collect()}
    assert got == {1: (200000, 200000, ["10", "9"]), 2: (9, 0, []), 3: (2000, 2000, ["10", "9"])}


def test_a_text_and_an_item_of_one_repeated_passage(spark):
    passage = "one two three four five six seven eight nine ten "
    docs = spark.createDataFrame([(1, passage * 3000)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, passage * 200) for i in range(30)], "item_id bigint, text string")
    got = D.contamination(docs, bench).first()
    assert (got.n_hit, len(got.item_ids)) == (30000, 30)


def test_match_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, f"x {item} y two"), (2, "one two three five"), (3, item[4:])],
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame([(5, item), (6, "two x three"), (7, "one three")], "item_id bigint, text string")
    got = D.matches(docs, bench).collect()
    words = {(r.doc_id, p) for r in got if r.kind == "phrase" for p in range(r.start, r.start + r.length)}
    assert words == {(1, p) for p in range(1, 13)} | {(3, p) for p in range(11)}
    assert (2, "7") in {(r.doc_id, r.item_id) for r in got if r.kind == "proximity"}


def test_blocks_meet_at_every_offset(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 3)
    docs, items = case()
    got = D.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"),
                          spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, sorted(r.item_ids)) for r in got], key=repr) == brute(docs, items)
