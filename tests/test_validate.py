import json

from pyspark.sql import functions as F

from sitelens.functions.jsonpaths import json_leaves
from sitelens.operators import validate as VD


def check(spark, values, content):
    leaves = spark.createDataFrame([("s", f"f{i}", k, v, i) for i, (k, v) in enumerate(values)],
                                   "entity string, field_path string, kind string, value string, ord int")
    pages = spark.createDataFrame([("s", "http://s/1", 0, content)], "entity string, url string, page_seq bigint, text string")
    return {r.field_path: (r.is_valid, r.source_text, r.notes)
            for r in VD.validate_fields(leaves, pages, pages_per_cell=4).collect()}


def test_exact_fuzzy_and_skip(spark):
    content = "alpha beta gamma delta Not published 3 5"
    got = check(spark, [("string", "Alpha  BETA"), ("string", "alpha beta gamma zeta"),
                        ("string", "alpha beta zz yy"), ("string", ""), ("number", "3.5"),
                        ("boolean", "true"), ("null", None), ("string", "Not published"),
                        ("string", "not published"), ("string", "3.5")], content)
    assert got["f0"] == (True, "alpha beta", "Exact match found")
    assert got["f1"] == (True, "alpha beta gamma zeta", "Fuzzy match (3/4 words)")
    assert got["f2"] == (False, "", "No match found")
    assert got["f3"] == (True, "", "Exact match found")
    for f in ("f4", "f5", "f6", "f7"):
        assert got[f] == (True, "", VD.SKIPPED)
    assert got["f8"] == (True, "not published", "Exact match found")
    assert got["f9"] == (False, "", "No match found")   # punctuation removed from content only


def test_leaf_paths(spark):
    doc = json.dumps({"a": {"b": [{"c": 1}, 2, [3]]}, "d": {}})
    df = spark.createDataFrame([(doc,)], "json string")
    out = json_leaves(df, "json", []).orderBy("ord").collect()
    assert [(r.field_path, r.kind, r.value) for r in out] == [
        ("a.b[0].c", "number", "1"), ("a.b[1]", "number", "2"), ("a.b[2]", "array", "[3]")]


def test_structure(spark):
    sp = spark.createDataFrame([(["a"], "object", 0), (["a", "b"], "number", 1), (["c"], "number", 2),
                                (["d", "e"], "string", 3)], "path array<string>, kind string, ord int")
    # a data key with a dot is no path of two keys
    dn = spark.createDataFrame([("s", ["a"], "number"), ("s", ["d.e"], "string")],
                               "entity string, path array<string>, kind string")
    out = sorted((r.path, r.issue) for r in VD.structure_issues(sp, dn).collect())
    assert out == [("a", "Type mismatch at a: expected dict"), ("c", "Missing required field: c"),
                   ("d.e", "Missing required field: d.e")]


def test_summary_counts(spark):
    res = spark.createDataFrame(
        [("s", "a", True, "Exact match found"), ("s", "b", False, "No match found"),
         ("s", "c", True, VD.SKIPPED), ("s", "d", True, "Fuzzy match (3/4 words)")],
        "entity string, field_path string, is_valid boolean, notes string")
    r = VD.summary(res, ["entity"]).collect()[0]
    assert (r.total_fields, r.valid_fields, r.invalid_fields, r.exact_matches, r.fuzzy_matches, r.not_published) == \
        (4, 3, 1, 1, 1, 1)
    assert r.validation_rate == 75.0


def test_salted_pairs_cover_every_page(spark):
    leaves = spark.createDataFrame([("big", f"f{i}", "string", "x", i) for i in range(5)] + [("small", "g", "string", "x", 0)],
                                   "entity string, field_path string, kind string, value string, ord int")
    pages = spark.createDataFrame([("big", f"http://b/{i}", i, "x") for i in range(200)] + [("small", "http://s/0", 0, "y")],
                                  "entity string, url string, page_seq bigint, text string")
    res = VD.validate_fields(leaves, pages, pages_per_cell=16)
    counts = {r.entity: r.n for r in res.groupBy("entity").agg(F.count("*").alias("n")).collect()}
    assert counts == {"big": 1000, "small": 1}
