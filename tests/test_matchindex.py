"""Indexed validation against all pairs, and the incremental merge against the whole one."""

import json
import random

import pytest

from sitelens.operators import matchindex as MI
from sitelens.operators import merge as MG
from sitelens.operators import validate as VD
from sitelens.session import scratch_dir


def inputs(spark, seed):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "al", "a", "gamma3", "éta", "zz", "longerword", "Not", "published", "hab", "betas"]
    leaves, pages = [], []
    for e in ("s", "t", "u"):
        for i in range(14):
            kind = rnd.choice(["string"] * 5 + ["number", "null"])
            value = None if kind == "null" else rnd.choice(
                ["", "Not published", "  ", " ".join(rnd.choices(words, k=rnd.randrange(1, 7)))])
            leaves.append((e, f"f{i % 11}.x", kind, value, i))
        for k in range(0 if e == "u" else 9):
            pages.append((e, f"http://{e}/{k % 6}", k, " ".join(rnd.choices(words, k=rnd.randrange(12)))))
    leaves.append(leaves[3])
    return (spark.createDataFrame(leaves, "entity string, field_path string, kind string, value string, ord int"),
            spark.createDataFrame(pages, "entity string, url string, page_seq bigint, text string"))


def rows(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


SUMMARY = ["total_fields", "valid_fields", "invalid_fields", "validation_rate", "exact_matches", "fuzzy_matches",
           "not_published"]


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_equal_those_of_all_pairs(spark, seed):
    leaves, pages = inputs(spark, seed)
    every = VD.validate_fields(leaves, pages).cache()
    got = MI.IndexedValidation(leaves, pages)
    assert rows(got.summary(), "entity", *SUMMARY) == rows(VD.summary(every, ["entity"]), "entity", *SUMMARY)
    names = ["entity", "field_path", "valid_anywhere", "first_source_url", "pages_checked"]
    assert rows(got.verdicts(), *names) == rows(VD.verdicts(every), *names)
    names = ["entity", "section", "total_fields", "valid_fields", "level"]
    assert rows(got.rollup(), *names) == rows(VD.rollup(every), *names)
    # no pair is compared that shares none of the words asked for
    assert got.matches.count() < every.count() / 2


def test_a_page_counts_as_often_as_it_is_listed(spark):
    leaves, pages = inputs(spark, 3)
    listed = pages.where("page_seq < 5").selectExpr("*", "page_seq % 3 + 1 AS times")
    each = listed.selectExpr("entity", "url", "page_seq", "text", "explode(sequence(1, times)) AS copy").drop("copy")
    got = MI.IndexedValidation(leaves, listed)
    assert rows(got.summary(), "entity", *SUMMARY) == rows(VD.summary(VD.validate_fields(leaves, each), ["entity"]),
                                                            "entity", *SUMMARY)


def test_a_cell_sends_a_row_a_leaf_however_many_pages_it_stands_on(spark):
    words = ["the", "he", "then" * 9, "then" * 8 + "thex", "a" * 40]
    leaves = spark.createDataFrame([("s", f"tags[{k}]", "string", w, 0) for k, w in enumerate([*words, "the he nowhere a"])],
                                   "entity string, field_path string, kind string, value string, ord int")
    pages = spark.createDataFrame([("s", f"http://s/{k}", k, f"the {'then' * 9} x{k} " + "a" * (k % 50)) for k in range(600)],
                                  "entity string, url string, page_seq bigint, text string")
    every = VD.validate_fields(leaves, pages).cache()
    for chars, cells in ((10**6, 1), (10**4, 5)):
        got = MI.IndexedValidation(leaves, pages, chars)
        assert got.found.count() <= 5 * cells < 600 < got.matches.count()
        assert rows(got.summary(), "entity", *SUMMARY) == rows(VD.summary(every, ["entity"]), "entity", *SUMMARY)
        names = ["field_path", "valid_anywhere", "first_source_url", "pages_checked"]
        assert rows(got.verdicts(), *names) == rows(VD.verdicts(every), *names)
    names = ["field_path", "url", "is_valid", "source_text", "notes"]
    assert rows(got.matches.where("is_valid"), *names) == rows(every.where("is_valid"), *names)


def random_value(rnd, depth=0):
    kinds = [0, 1, None, "", "x", "y", True, [], [1], [1, 1, 2], ["x", {"k": 1}], {}]
    if depth < 2 and rnd.random() < 0.4:
        return {k: random_value(rnd, depth + 1) for k in rnd.sample("abc", rnd.randrange(1, 4))}
    return rnd.choice(kinds)


def test_any_split_of_the_fragments_merges_to_the_same_record(spark):
    rnd = random.Random(5)
    docs = [(f"e{i % 12}", i, json.dumps({k: random_value(rnd) for k in rnd.sample("abc", 2)}) if i % 9 else "{bad")
            for i in range(72)]
    frame = spark.createDataFrame(docs, "entity string, seq bigint, json string")
    node, item = ["entity", "path", "depth", "kind", "value", "source_seq"], ["entity", "path", "seq", "idx", "kind", "value"]
    merged, items, _ = MG.merge_fragments(frame, ["a", "z"])
    whole = rows(merged, *node), rows(items, *item)
    for split in ([0, 1, 2], [2, 0, 1]):
        store = MG.RecordStore(spark, scratch_dir(spark, "records"))
        for version, part in enumerate(split):
            batch = frame.where(f"(seq * 7 + seq div 5) % 3 = {part}")
            store.upsert(batch, version, ["a", "z"])
            if version == 1:
                store.upsert(batch, version, ["a", "z"])          # repeated after a failure
        merged, items = MG.finish(store.summary())
        assert (rows(merged, *node), rows(items, *item)) == whole
