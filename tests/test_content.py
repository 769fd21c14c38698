from conftest import pages_df
from pyspark.sql import functions as F

from sitelens.operators import content as CT


def one(html, **kw):
    return CT.crawl_content(CT.parse(html), **kw)


def test_article_wins_and_nested_text_once():
    html = "<nav><p>menu</p></nav><article><h1>Head</h1><p><b>One<br><p>Two</p></article><p>outside</p>"
    assert one(html) == "Head One Two "
    assert one(html, repeat_nested=True) == "Head One Two Two "


def test_empty_main_falls_back_to_document():
    html = "<main id='content'></main><div><p>a</p><li>b</li><td>c</td></div>"
    assert one(html) == "a b"


def test_skip_class_direct_and_two_levels_below():
    html = ('<article><p class="menu">skip</p><div class="nav"><p>skip2</p></div>'
            '<div class="menu"><div><p>keep</p></div></div></article>')
    assert one(html) == "keep "


def test_attribute_selector_cascade():
    html = '<div class="x-requirements-y"><p>req</p></div><div id="student-life"><p>stu</p></div>'
    assert one(html) == "req "


def test_dom_profile():
    html = ('<body><header>H</header><div class="content"><nav>N</nav><p>Hello <b>big</b>\n world</p>'
            '<div class="sidebar">S</div><script>x</script><p>End</p></div></body>')
    assert CT.dom_content(CT.parse(html)) == "Hello big world End"


def test_main_content_job(spark):
    p = pages_df(spark, [(1, "http://h.x/a", "<title>T</title><article><p>x</p></article>"),
                         (2, "http://h.x/b", "<body><p>y</p></body>")])
    out = {r.page_id: (r.title, r.content, r.dom_content) for r in CT.main_content(p).collect()}
    assert out == {1: ("T", "x ", "x"), 2: (None, "y", "y")}


def test_results_are_handed_back_a_few_pages_at_a_time(spark):
    """A batch of many pages gives its rows in order, whatever its size."""
    from sitelens.operators import content as CT
    n = 2 * CT.PAGES_AT_ONCE + 7
    html = F.concat(F.lit("<html><body><main><p>page "), F.col("id"), F.lit("</p></main></body></html>"))
    pages = spark.range(0, n, 1, 1).select(F.lit("s").alias("entity"), F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                           F.when(F.col("id") != 5, html).alias("html"))
    rows = CT.main_content(pages).collect()
    assert [r.page_id for r in rows] == list(range(n))
    assert all(r.dom_content == f"page {r.page_id}" for r in rows if r.page_id != 5) and rows[5].dom_content == ""


def test_whitespace_is_squashed_as_python_does(spark):
    import random
    from pyspark.sql import functions as F
    from sitelens.functions.text import squash_ws
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("ab  \t\n\r\x1c\x1f\x85\xa0\u2003\u2028\u3000\x0b", k=rnd.randrange(12))) for _ in range(400)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(squash_ws(F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == [" ".join(t.split()) for t in texts]


def test_every_name_of_a_character_is_decoded(spark):
    import html.entities
    from pyspark.sql import functions as F
    from sitelens.functions.text import unescape
    names = [(f"a&{k}b&{k}", f"a{v}b{v}") for k, v in html.entities.html5.items() if k.endswith(";")]
    got = spark.createDataFrame(names, "t string, want string").where(unescape(F.col("t")) != F.col("want")).collect()
    assert not got and len(names) > 2000
