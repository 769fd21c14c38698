import json

import pytest
from pyspark.sql import functions as F

from sitelens.operators import merge as MG
from sitelens.operators import validate as VD
from sitelens.session import scratch_dir
from sitelens.sources import parts as PT
from sitelens.sources import sinks as SK


def written(spark, pieces, order, per_part):
    root = scratch_dir(spark, "test-parts")
    listed = PT.write_parts(pieces, order, root, per_part).orderBy("entity", "part").collect()
    texts: dict = {}
    for r in PT.read_parts(spark, root).orderBy("entity", "part").collect():
        texts.setdefault(r.entity, []).append(r.text)
    return root, listed, texts


def test_hot_document_spans_parts_in_order(spark):
    rows = [("hot", i, f"line {i} é") for i in range(20_000)] + [(f"s{k}", i, f"{k}/{i}") for k in range(5) for i in range(3)]
    rows += [(None, 0, "nobody's")]
    pieces = spark.createDataFrame(rows, "entity string, n bigint, value string").orderBy(F.rand(seed=3))
    root, listed, texts = written(spark, pieces, ["n"], 1_000)
    assert len(texts["hot"]) > 10
    assert max(t.count("\n") for ts in texts.values() for t in ts) < 4_000        # no task holds the document
    for name in ("hot", "s3"):
        assert "".join(texts[name]) == "".join(v + "\n" for e, _, v in rows if e == name)
    assert "".join(texts[""]) == "nobody's\n"
    # offsets are those of the bytes
    for e in texts:
        at = 0
        for k, (r, t) in enumerate(zip([r for r in listed if r.entity == e], texts[e], strict=True)):
            assert (r.part, r.offset, r.n_bytes) == (k, at, len(t.encode()))
            at += r.n_bytes
    got = PT.read_lines(spark, root).where("entity = 'hot'").orderBy("line").collect()
    assert [(r.line, r.text) for r in got] == [(i, f"line {i} é") for i in range(20_000)]


def test_no_pieces_give_no_documents(spark):
    empty = spark.createDataFrame([], "entity string, n bigint, value string")
    root = scratch_dir(spark, "test-parts")
    assert PT.write_parts(empty, ["n"], root).count() == 0
    assert PT.read_lines(spark, root).count() == 0


def test_parts_are_written_once(spark):
    one = spark.createDataFrame([("s", 0, "x")], "entity string, n bigint, value string")
    root = scratch_dir(spark, "test-parts")
    PT.write_parts(one, ["n"], root)
    with pytest.raises(Exception, match="(?i)exist"):
        PT.write_parts(one, ["n"], root)


@pytest.mark.parametrize("per_part", [3, 10_000])
def test_record_pieces_are_the_indented_json(spark, per_part):
    frags = [{"b": {"y": 'quo"te\n', "x": {}, "z": {"deep": [1, 2, "three"], "n": None}}, "a": [], "l": [True, {"k": [1]}]},
             {"b": {"z": {"deep": ["four"]}}, "a~": "tilde", "a b": 1.5, "l": [False]}]
    df = spark.createDataFrame([("s", i, json.dumps(f)) for i, f in enumerate(frags)] + [("t", 0, '{"only": ""}')],
                               "entity string, seq bigint, json string")
    merged, items, _ = MG.merge_fragments(df)
    _, _, texts = written(spark, SK.record_pieces(merged, items), SK.RECORD_ORDER, per_part)
    docs = {r.entity: json.loads(r.json) for r in MG.records_json(merged, items).collect()}
    for e in ("s", "t"):
        text = "".join(texts[e])
        assert json.loads(text) == docs[e]
        members = json.dumps(docs[e], indent=2, sort_keys=True, ensure_ascii=False)
        # an item that is an object stays on one line
        members = members.replace('{\n              "k": [\n                1\n              ]\n            }', '{"k": [1]}')
        assert text.replace('{"k":[1]}', '{"k": [1]}') == members + "\n"


@pytest.mark.parametrize("per_part", [7, 10_000])
def test_report_pieces_are_the_report(spark, per_part):
    rows = [("s", f"f{i}", 0, f"http://s/{p}", p, (i + p) % 3 > 0, "t" * 150 if i % 2 else "", "Exact match found")
            for p in range(9) for i in range(8)]
    res = spark.createDataFrame(rows, "entity string, field_path string, ord int, url string, page_seq bigint, "
                                      "is_valid boolean, source_text string, notes string")
    summary = VD.summary(res, ["entity"])
    _, _, texts = written(spark, SK.report_pieces(res, summary, "2024-01-01T00:00:00"), SK.REPORT_ORDER, per_part)
    whole = SK.validation_report(res, summary, "2024-01-01T00:00:00").collect()[0].json
    assert "".join(texts["s"]) == whole + "\n"
    assert "Detailed Results:\n\nField: f0\nValid: False\nSource URL: http://s/0\nNotes: " in whole
    assert "Source text: " + "t" * 100 + "...\n" in whole and whole.count("\nField: ") == 72


def test_the_writer_keeps_the_order(spark):
    pieces = spark.createDataFrame([("s", i, "x") for i in range(10)], "entity string, n bigint, value string")
    out = PT.dealt(pieces, ["n"], 4)
    assert not out.schema["entity"].nullable and out.rdd.getNumPartitions() == 4


def test_number_of_parts_is_bounded_for_small_parts():
    assert [PT.parts_of(n, 500) for n in (0, 1, 501, 10_000)] == [0, 1, 2, 20]
    assert PT.parts_of(10_000_000, 500) == PT.SMALL_PARTS
    assert PT.parts_of(100_000_000, 500) == 500 == PT.parts_of(100_000_000, PT.PIECES_PER_PART)
    assert PT.parts_of(5_000_000, 1_000_000) == 5


def test_lines_are_read_in_splits_whatever_the_part(spark):
    # odd pieces: empty, with carriage returns and line feeds of their own, a byte order mark first
    odd = ["", "\ufeffmark", "a\r", "\rb\n", "\n", "é" * 300, "\ufeff"]
    rows = [("s", i, odd[i % 7] if i % 3 else f"line {i}") for i in range(3_000)] + [("t", 0, "\ufeffonly"), (None, 0, "")]
    rows += [("u", 0, "\ufeff")]
    root = scratch_dir(spark, "test-parts")
    PT.write_parts(spark.createDataFrame(rows, "entity string, n bigint, value string").repartition(3), ["n"], root)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = PT.read_lines(spark, root)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        lines = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    # a part of one file is many rows from the scan on
    assert "Generate" not in plan and "split(" not in plan
    for entity in ("s", "t", "u", ""):
        document = "".join(v + "\n" for e, _, v in rows if (e or "") == entity)
        want = document.split("\n")[:-1]
        assert [(r.line, r.text) for r in sorted((r for r in lines if r.entity == entity))] == list(enumerate(want))


def test_parts_that_are_not_listed_are_not_read(spark):
    root = scratch_dir(spark, "test-parts")
    PT.write_parts(spark.createDataFrame([("s", 0, "x")], "entity string, n bigint, value string"), ["n"], root)
    spark.createDataFrame([("s", 7, "unfinished")], "entity string, split bigint, value string").write.mode(
        "append").partitionBy("entity", "split").text(f"{root}/parts")
    assert [tuple(r) for r in PT.read_lines(spark, root).collect()] == [("s", 0, "x")]
