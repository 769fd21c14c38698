import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import pages_df
from sitelens.functions import html as H
from sitelens.operators import links as LK
from sitelens.operators import sections as SC
from sitelens.sources import sinks as SK
from sitelens.sources import tables as TB


def test_ranked_documents_round_trip(spark):
    ranked = spark.createDataFrame([("s", 1, "http://s/a", "admission", 1), ("s", 2, "http://s/b", "program", 1)],
                                   "entity string, rank int, url string, text string, relevance_score int")
    out = tempfile.mkdtemp(prefix="sink-")
    docs = SK.ranked_url_documents(ranked, "2023-03-04 05:06:07")
    doc = json.loads(docs.collect()[0].json)
    assert doc["timestamp"] == "20230304_050607" and [u["url"] for u in doc["urls"]] == ["http://s/a", "http://s/b"]
    SK.write_documents(docs, out + "/ranked")
    back = TB.ranked_urls(spark, out + "/ranked/entity=s").orderBy("rank").collect()
    assert [(r.rank, r.url, r.relevance_score) for r in back] == [(1, "http://s/a", 1), (2, "http://s/b", 1)]


def test_crawl_result_round_trip_feeds_ranking(spark):
    html = ('<title>T</title><h1>H</h1><nav><a href="/adm">Admission office</a><a href="/c">Contact admission</a>'
            '<a href="/p">Program</a></nav><article><p>requirement gpa</p></article>')
    # the second URL is carried by two pages, the third visited URL by none
    p = pages_df(spark, [(0, "http://s.x/", html), (1, "http://s.x/two", html.replace("/p", "/q")),
                         (2, "http://s.x/two", "<title>copy</title>")])
    links = LK.extract_links(p)
    meta = p.select("entity", "page_id", "url", H.title(F.col("html")).alias("title"),
                    H.headings(F.col("html"), 1).alias("h1"), H.headings(F.col("html"), 2, 2).alias("h2"),
                    H.meta_description(F.col("html")).alias("description"))
    visited = spark.createDataFrame([("s.x", "http://s.x/", 0), ("s.x", "http://s.x/two", 1), ("s.x", "http://s.x/gone", 1)],
                                    "entity string, url string, depth int")
    analysis = spark.createDataFrame([("s.x", 0, ["a"]), ("s.x", 1, ["b"]), ("s.x", 2, ["b"])],
                                     "entity string, page_id bigint, relevant_sections array<string>")
    base = spark.createDataFrame([("s.x", "http://s.x/")], "entity string, url string")
    priorities = SC.link_analysis(links, {"a": ["admission office"]})
    docs = SK.crawl_result_documents(visited, analysis, meta, links, priorities, base, "2024-01-01 00:00:00")
    d = json.loads(docs.collect()[0].json)
    assert list(d["relevant_urls"]) == ["http://s.x/", "http://s.x/two"]
    assert d["crawl_stats"]["total_pages_visited"] == 3 and d["crawl_stats"]["relevant_pages_found"] == 2
    assert d["relevant_urls"]["http://s.x/"]["relevant_links"] == ["http://s.x/adm"]
    assert d["relevant_urls"]["http://s.x/two"]["metadata"]["title"] == "T"
    out = tempfile.mkdtemp(prefix="sink-")
    path = os.path.join(out, "crawl.json")
    with open(path, "w") as f:
        f.write(json.dumps(d, indent=2))
    back = TB.crawl_result_links(spark, path)
    ranked = LK.rank_links(back).orderBy("rank").collect()
    assert [(r.url, r.relevance_score) for r in ranked] == [("http://s.x/adm", 1), ("http://s.x/p", 1), ("http://s.x/q", 1)]


def test_url_list_keeps_blank_lines(spark):
    out = tempfile.mkdtemp(prefix="urls-")
    with open(os.path.join(out, "u.txt"), "w") as f:
        f.write("  http://a/x \n\nhttp://a/x\n")
    assert [r.url for r in TB.url_list(spark, out).collect()] == ["http://a/x", "", "http://a/x"]


def test_taxonomy_reader_checks_shape(spark):
    import pytest
    out = tempfile.mkdtemp(prefix="tax-")
    good, bad = os.path.join(out, "good.json"), os.path.join(out, "bad.json")
    with open(good, "w") as f:
        json.dump({"institutions": [{"programs": [{"a": {"b": 1}}]}]}, f)
    with open(bad, "w") as f:
        json.dump({"institutions": [{"name": "x"}]}, f)
    assert json.loads(TB.taxonomy_program(spark, good).collect()[0].program_json) == {"a": {"b": 1}}
    with pytest.raises(Exception, match="programs"):
        TB.taxonomy_program(spark, bad).collect()


def test_single_page_result(spark):
    frags = spark.createDataFrame([("s", 1, "http://s/a", '{"a": 1}'), ("s", 2, "http://s/b", '{"b": 2}')],
                                  "entity string, seq bigint, source_url string, json string")
    out = tempfile.mkdtemp(prefix="one-") + "/r"
    SK.single_page_result(frags, "http://s/b", out)
    assert [r.value for r in spark.read.text(out).collect()] == ['{"b": 2}']
