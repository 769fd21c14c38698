from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from conftest import pages_df
from sitelens import vocab
from sitelens.functions import urls
from sitelens.operators import links as LK


def links_df(spark, rows):
    """rows: (entity, page_seq, link_seq, url, text)"""
    return spark.createDataFrame(rows, "entity string, page_seq bigint, link_seq int, url string, text string")


def test_late_good_link_kept_once_with_later_text(spark):
    df = links_df(spark, [("s", 0, 0, "http://s/a", "contact admission"), ("s", 1, 0, "http://s/a", "admission")])
    out = LK.rank_links(df).collect()
    assert [(r.url, r.text) for r in out] == [("http://s/a", "admission")]


def test_substring_skip_drops_research(spark):
    df = links_df(spark, [("s", 0, 0, "http://s/r", "student research program")])
    assert LK.rank_links(df).count() == 0


def test_in_state_scores_two(spark):
    df = links_df(spark, [("s", 0, 0, "http://s/t", "in-state tuition")])
    assert LK.rank_links(df).collect()[0].relevance_score == 2


def test_stable_ties_and_cut(spark):
    rows = [("s", i // 10, i % 10, f"http://s/{i}", "program") for i in range(30)]
    out = LK.rank_links(links_df(spark, rows)).orderBy("rank").collect()
    assert len(out) == 25
    assert [r.url for r in out] == [f"http://s/{i}" for i in range(25)]


def test_top_k_is_per_site(spark):
    rows = [(s, 0, i, f"http://{s}/{i}", "program") for s in ("a", "b") for i in range(30)]
    out = LK.rank_links(links_df(spark, rows))
    assert sorted((r.entity, r.n) for r in out.groupBy("entity").agg(F.count("*").alias("n")).collect()) == \
        [("a", 25), ("b", 25)]


CASES = ["/c", "c?z", "//k/c", "../c", "#f", "mailto:a@b", "", "?y", "./d/../e/", "../../../x", "a/./b/.",
         "/a/b/../../..", "c/..", "http://other/x", "g;x?y#s", "..", ".", "./", "/./a", "a//b"]
BASES = ["https://h.x/a/b?q=1#t", "http://h.x", "http://h.x/", "http://u@h.x:80/p/q/r", "https://h.x/a/b/"]


@pytest.mark.parametrize("base", BASES)
def test_resolve_matches_urljoin(spark, base):
    df = spark.createDataFrame([(base, h) for h in CASES], "b string, h string")
    got = [r.u for r in df.select(urls.resolve(F.col("b"), F.col("h")).alias("u")).collect()]
    assert got == [urljoin(base, h) for h in CASES]


def test_document_substring_rejected(spark):
    rows = [("h.x", 0, 0, "http://h.x/x.documents/admission", "admission"),
            ("h.x", 0, 1, "http://h.x/a.PDF?x=admission", "admission"),
            ("h.x", 0, 2, "http://h.x/ok", "admission"),
            ("h.x", 0, 3, "http://other.x/ok", "admission"),
            ("h.x", 0, 4, "ftp://h.x/ok", "admission")]
    df = links_df(spark, rows)
    assert [r.url for r in LK.crawlable(df).collect()] == ["http://h.x/ok"]


def test_anchor_extraction(spark):
    html = ('<html><head><title>T &amp; U</title><script>var a="<a href=\'/no\'>x</a>";</script></head><body>'
            '<a href="/one" title="One">  Hello <b>World</b> </a><a name="x">no href</a>'
            "<A HREF='/two'>Two&nbsp;</A><a href=/three>3</a><!-- <a href='/c'>c</a> --></body></html>")
    p = pages_df(spark, [(1, "https://h.x/p/q", html)])
    out = LK.extract_links(p).orderBy("link_seq").collect()
    assert [(r.link_seq, r.url, r.text, r.title) for r in out] == [
        (0, "https://h.x/one", "helloworld", "One"),
        (1, "https://h.x/two", "two", ""),
        (2, "https://h.x/three", "3", ""),
    ]


def test_default_vocabularies_have_reference_sizes():
    assert len(vocab.CRAWL_LINK_KEYWORDS) == 37 and len(set(vocab.CRAWL_LINK_KEYWORDS)) == 35
    assert len(vocab.RANK_KEEP_KEYWORDS) == 23 and len(vocab.RANK_SKIP_KEYWORDS) == 12
    assert len(vocab.SECTION_KEYWORDS) == 11 and len(vocab.CRAWL_CONTENT_SELECTORS) == 22


def test_min_score_threshold(spark):
    df = links_df(spark, [("s", 0, 0, "http://s/a", "in-state program"), ("s", 0, 1, "http://s/b", "program")])
    assert [r.url for r in LK.rank_links(df, min_score=2).collect()] == ["http://s/a"]
