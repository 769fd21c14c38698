import json
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from conftest import pages_df
from sitelens.operators import merge as MG
from sitelens.operators import sections as SC
from sitelens.sources import sinks as SK
from sitelens.streaming import streams as ST


def test_rule_analyzer_and_user_analyzer(spark):
    df = spark.createDataFrame([("e", 1, "u1", "interview and gpa"), ("e", 2, "u2", "nothing here")],
                               "entity string, page_id bigint, url string, content string")
    rule = {r.page_id: (r.relevant_sections, dict(r.section_confidence)) for r in SC.analyze_pages(df).collect()}
    assert rule[1] == (["application_requirements", "interview_process"],
                       {"application_requirements": 0.3, "interview_process": 0.3})
    assert rule[2] == ([], {})

    def model(batches):
        for pdf in batches:
            yield pd.DataFrame({"entity": pdf.entity, "page_id": pdf.page_id,
                                "relevant_sections": [["x"] for _ in range(len(pdf))],
                                "section_confidence": [{"x": 1.0} for _ in range(len(pdf))]})
    user = SC.analyze_pages(df, analyzer=model).collect()
    assert sorted(r.page_id for r in user) == [1, 2] and user[0].relevant_sections == ["x"]


def test_record_documents(spark):
    rows = [("s", 0, json.dumps({"a": "", "l": [1]})), ("s", 1, json.dumps({"a": "x", "l": [1, 2]}))]
    frags = spark.createDataFrame(rows, "entity string, seq bigint, json string")
    merged, items, _ = MG.merge_fragments(frags)
    doc = json.loads(MG.records_json(merged, items).collect()[0].json)
    assert doc == {"institutions": [{"institution_name": "s", "programs": [{"a": "x", "l": [1, 2]}]}]}


def test_validation_report_text(spark):
    res = spark.createDataFrame(
        [("s", "title", 0, "http://s/1", 0, True, "hello", "Exact match found"),
         ("s", "n", 1, "http://s/1", 0, True, "", "Non-string or 'Not published' value")],
        "entity string, field_path string, ord int, url string, page_seq bigint, is_valid boolean, "
        "source_text string, notes string")
    from sitelens.operators import validate as VD
    text = SK.validation_report(res, VD.summary(res, ["entity"]), "2024-01-01T00:00:00").collect()[0].json
    assert "Validation rate: 100.00%" in text
    assert "Field: title\nValid: True\nSource URL: http://s/1\nSource text: hello...\nNotes: Exact match found" in text
    assert "Not published fields: 1" in text


def test_url_stream_dedup_across_batches(spark):
    folder = tempfile.mkdtemp(prefix="stream-pages-")
    html = '<a href="/a">A</a><a href="/b">B</a>'
    for i, rows in enumerate([[(1, "http://h.x/p1", html)], [(2, "http://h.x/p2", html + '<a href="/c">C</a>')]]):
        spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(
            os.path.join(folder, f"batch{i}"))
    pages = ST.stream_pages(spark, os.path.join(folder, "*"), max_files=1)
    out = tempfile.mkdtemp(prefix="stream-out-")
    ST._run(ST.new_url_stream(pages), out)
    got = sorted(r.url for r in spark.read.parquet(out).collect())
    assert got == ["http://h.x/a", "http://h.x/b", "http://h.x/c"]
    assert F is not None


def test_non_web_and_content_type(spark):
    from sitelens.operators import records as RC
    df = spark.createDataFrame([("http://h/x.PPTX", "text/html; charset=utf-8"), ("http://h/a", None),
                                ("http://h/b", "application/pdf")], "url string, ct string")
    got = [(r.nw, r.html) for r in df.select(RC.non_web(F.col("url")).alias("nw"),
                                             RC.is_html(F.col("ct")).alias("html")).collect()]
    assert got == [(True, True), (False, False), (False, False)]


def test_url_status_and_accessible_only(spark):
    import datetime as dt
    from sitelens.operators import fetchlog as FL
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [("http://a/x", t, 1, 500), ("http://a/x", t, 2, 500), ("http://a/x", t, 3, 200),
         ("http://a/y", t, 4, 500), ("http://a/y", t, 5, 500), ("http://a/y", t, 6, 500), ("http://a/y", t, 7, 200)],
        "url string, ts timestamp, event_id bigint, status int")
    urls = spark.createDataFrame([("http://a/x",), ("http://a/y",), ("not a url",)], "url string")
    st = {r.url: (r.accessible, r.attempts_used, r.well_formed) for r in FL.url_status(log, urls).collect()}
    assert st == {"http://a/x": (True, 3, True), "http://a/y": (False, 3, True), "not a url": (False, 0, False)}
    assert [r.url for r in FL.accessible_only(urls, FL.url_status(log, urls)).collect()] == ["http://a/x"]
