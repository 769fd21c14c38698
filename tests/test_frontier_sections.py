from pyspark.sql import functions as F

from sitelens.operators import frontier as FR
from sitelens.operators import sections as SC


def test_confidence_steps(spark):
    secs = {"s": ["a", "b", "c", "d"]}
    df = spark.createDataFrame([("e", 1, "a"), ("e", 2, "a b"), ("e", 3, "a b c"), ("e", 4, "a b c d"), ("e", 5, "zz")],
                               "entity string, page_id bigint, content string")
    out = {r.page_id: r.confidence for r in SC.page_sections(df, sections=secs).collect()}
    assert out == {1: 0.3, 2: 0.6, 3: 0.8999999999999999, 4: 0.9}


def test_category_ties_take_taxonomy_order(spark):
    secs = {"x": ["a"], "y": ["b"]}
    df = spark.createDataFrame([("e", 1, "a b")], "entity string, page_id bigint, content string")
    assert SC.page_category(SC.page_sections(df, sections=secs)).collect()[0].category == "x"


def test_frontier_reach_and_depth(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("s", "a"), ("t", "x")], "entity string, url string")
    got = sorted((r.entity, r.url, r.depth) for r in FR.crawl(seeds, edges).collect())
    assert got == [("s", "a", 0), ("s", "b", 1), ("s", "c", 2), ("s", "d", 3), ("t", "x", 0), ("t", "y", 1)]


def test_frontier_stops_when_sections_covered(spark):
    # chain p1 -> p2 -> p3 -> p4; sections complete once p3 is visited
    edges = spark.createDataFrame([("p1", "p2"), ("p2", "p3"), ("p3", "p4")], "src string, dst string")
    seeds = spark.createDataFrame([("s", "p1")], "entity string, url string")
    ps = spark.createDataFrame([("p1", "A"), ("p2", "B"), ("p3", "C"), ("p4", "A")], "url string, section string")
    got = sorted(r.url for r in FR.crawl(seeds, edges, page_sections=ps, required=["A", "B", "C"]).collect())
    assert got == ["p1", "p2", "p3"]
    stats = FR.crawl_stats(FR.crawl(seeds, edges), ps).collect()[0]
    assert (stats.total_pages_visited, stats.relevant_pages_found) == (4, 4)


def test_link_analysis_emits_only_matching_links(spark):
    links = spark.createDataFrame([("e", 1, 0, "u0", "Interview day"), ("e", 1, 1, "u1", "home"), ("e", 1, 2, "u2", "  ")],
                                  "entity string, page_id bigint, link_seq int, url string, text string")
    out = SC.link_analysis(links).collect()
    assert [(r.url, r.priority, r.relevance_score, r.expected_content) for r in out] == \
        [("u0", "high", 0.8, ["interview_process"])]
    assert F is not None


def test_compaction_keeps_results(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(12)], "src string, dst string")
    seeds = spark.createDataFrame([("s", "n0")], "entity string, url string")
    got = sorted((r.url, r.depth) for r in FR.crawl(seeds, edges, compact_every=3).collect())
    assert got == sorted((f"n{i}", i) for i in range(13))


def test_long_chain_is_crawled_to_its_end(spark):
    n = 56
    seeds = spark.createDataFrame([("s", "u0")], "entity string, url string")
    edges = spark.createDataFrame([(f"u{i}", f"u{i + 1}") for i in range(n)], "src string, dst string")
    got = {r.url: r.depth for r in FR.crawl(seeds, edges).collect()}
    assert got == {f"u{i}": i for i in range(n + 1)}


def test_hub_is_spread_by_its_measured_links(spark, monkeypatch):
    monkeypatch.setattr(FR, "LINKS_PER_CELL", 5)
    edges = spark.createDataFrame([("hub", f"u{i}", "high") for i in range(40)] + [("a", "b", "high")],
                                  "src string, dst string, priority string")
    cells = {(r.src, r.salt) for r in FR._cells(edges).collect()}
    assert ("a", 0) in cells and len(cells) > 4


def test_min_priority(spark):
    df = spark.createDataFrame([("a", "high"), ("b", "medium"), ("c", "low"), ("d", None)], "url string, priority string")
    assert {r.url for r in SC.min_priority(df).collect()} == {"a", "b"}
    assert {r.url for r in SC.min_priority(df, "low").collect()} == {"a", "b", "c"}
