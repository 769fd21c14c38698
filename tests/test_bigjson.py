import json
import os
import random
import tempfile

import pytest
from pyspark.sql import types as T

from sitelens.session import scratch_dir
from sitelens.sources import bigjson as BJ
from sitelens.sources import parts as PT


@pytest.fixture
def small_splits(spark):
    """Splits of 97 bytes: strings, escapes and characters of several bytes lie across their borders."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice([None, True, False, 0, -1.5, 12])
    if kind < 4:
        return "".join(rng.choice('ab"\\{}[],:\n é𝄞') for _ in range(rng.randrange(12)))
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f'k{i}"' if rng.random() < 0.2 else f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(4))}


def written(*texts):
    out = tempfile.mkdtemp(prefix="big-json-")
    for i, t in enumerate(texts):
        with open(os.path.join(out, f"{i}.json"), "w") as f:
            f.write(t)
    return out


def members(df):
    got: dict = {}
    for r in df.orderBy("file", "idx").collect():
        got.setdefault(int(r.file.rsplit("/", 1)[1][0]), []).append((r.idx, r.key, json.loads(r.json)))
    return got


def test_members_equal_the_parsed_document(spark, small_splits):
    rng = random.Random(5)
    inner = [{f"m{i}\\\"": value(rng) for i in range(20)}, [value(rng) for _ in range(20)], {}, [], "scalar"]
    docs = [{"x": value(rng), "at": {"no": value(rng)}, "in": [value(rng), {"deep": c, "z": value(rng)}]} for c in inner]
    folder = written(*[json.dumps(d, indent=rng.choice([None, 2]), ensure_ascii=bool(i % 2)) for i, d in enumerate(docs)])
    got = members(BJ.json_members(spark, folder, ["in", 1, "deep"]))
    want = {0: [(i, k, v) for i, (k, v) in enumerate(inner[0].items())], 1: [(i, None, v) for i, v in enumerate(inner[1])]}
    assert got == want


def test_root_members_and_repeated_keys(spark, small_splits):
    folder = written('{"a": 1, "b": {"c": [1]}, "b": {"c": [2, "x"]}}', '["p", {"q": "r"}, [ ] ]', "{ }")
    assert members(BJ.json_members(spark, folder, [])) == {
        0: [(0, "a", 1), (1, "b", {"c": [1]}), (2, "b", {"c": [2, "x"]})], 1: [(0, None, "p"), (1, None, {"q": "r"}), (2, None, [])]}
    # the last of a key given twice, as a parser has it
    assert members(BJ.json_members(spark, folder, ["b", "c"])) == {0: [(0, None, 2), (1, None, "x")]}


def test_document_in_parts(spark):
    doc = {"list": [f'item "{i}", [é' for i in range(400)], "other": 1}
    lines = json.dumps(doc, indent=1, ensure_ascii=False).split("\n")
    pieces = spark.createDataFrame([("e", i, t) for i, t in enumerate(lines)], "entity string, n bigint, value string")
    root = scratch_dir(spark, "test-big")
    assert PT.write_parts(pieces, ["n"], root, 50).count() > 4
    got = BJ.json_members(spark, f"{root}/parts", ["list"], PT.PARTITIONS, "split").orderBy("idx").collect()
    assert [(r.entity, r.idx, json.loads(r.json)) for r in got] == [("e", i, t) for i, t in enumerate(doc["list"])]


def test_one_file_is_read_in_several_tasks(spark, small_splits):
    folder = written(json.dumps({"list": [f"item {i}" for i in range(500)]}))
    rows, keys, block = BJ._records(spark, folder, T.StructType([]), None)
    assert keys == ["file"] and rows.select(*block).distinct().count() > 20
    assert BJ.json_members(spark, folder, ["list"]).count() == 500
