"""References, whitespace, descriptions and padded URLs against Python's own."""

import html
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from sitelens.functions import html as H
from sitelens.functions import text as TX
from sitelens.functions import urls as U
from sitelens.operators import content as CT


def column(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r.o for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


def test_references(spark):
    texts = ["Caf&eacute; &#8217;x&mdash;y", "&amp;lt; &amp;amp;", "a & b &unknown; &", "&#x1F600;&#128512;", "&#0;&#xD800;",
             "&#146;&#x92;", "&NotEqualTilde;", "&lt;b&gt;", "", "plain", "&;&#;&#x;", "&nbsp;x&copy;"]
    assert column(spark, texts, TX.unescape) == [html.unescape(t) for t in texts]


def test_unicode_whitespace(spark):
    texts = [" a b　", " \x1c\x85 x\t\n y ", "​", "a b\x0bc", ""]
    assert column(spark, texts, TX.squash_ws) == [" ".join(t.split()) for t in texts]
    assert column(spark, texts, TX.strip_ws) == [t.strip() for t in texts]


def test_meta_description(spark):
    pages = ['<meta name="description" content="one">', "<meta content='two' name='Description'>",
             '<meta content=three name=description><meta name=description content="later">', "<meta name='x' content='y'>",
             '<meta name="description" content="">', '<!-- <meta name="description" content="no"> -->',
             '<meta\nproperty="og:x" content="q"><META NAME="DESCRIPTION" CONTENT="Caf&eacute; &amp; co">']
    assert column(spark, pages, H.meta_description) == ["one", "two", "three", None, None, None, "Café & co"]


@pytest.mark.parametrize("base", ["https://h.x/a/b", "http://h.x", "https://h.x/a/?q#f"])
def test_padded_references(spark, base):
    refs = [" /x", "\n/x", "\t\x00 y", "/a\nb\tc", " https://h.x/z", " http://o.x/z", " mailto:a@b", "  ", " #f", " ?q", "x ",
            " //o.y/p", "\r../up"]
    got = column(spark, refs, lambda c: U.resolve(F.lit(base), c))
    assert got == [urljoin(base, r) for r in refs]


def test_deep_pages_are_walked():
    page = "<body><article>" + "<p>" * 20_000 + "deep text" + "<div>" * 20_000 + "more"
    root = CT.parse(page)
    assert "deep text" in CT.crawl_content(root)
    assert "deep text" in CT.dom_content(root)
