"""The four stages of the site-facts workflow as whole-corpus Spark jobs.

1. ``crawl_sites``: pages -> content, links, rule/model analysis, frontier
   rounds until each site's sections are covered -> crawl results.
2. ``rank_sites``: crawl-result links -> filtered, de-duplicated, top links.
3. ``extract_records``: ranked pages -> fragments (user extractor or rules)
   -> order-sensitive deep merge -> one record per site.
4. ``validate_records``: record leaves x accessible pages -> field results,
   summaries, structure issues and text reports.

Every stage takes and returns DataFrames; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens import taxonomy as TXN
from sitelens import vocab
from sitelens.functions import html as H
from sitelens.functions.jsonpaths import schema_paths
from sitelens.operators import content as CT
from sitelens.operators import frontier as FR
from sitelens.operators import links as LK
from sitelens.operators import merge as MG
from sitelens.operators import records as RC
from sitelens.operators import sections as SC
from sitelens.operators import validate as VD
from sitelens.sources import sinks as SK


@dataclass
class CrawlOutput:
    visited: DataFrame
    analysis: DataFrame
    links: DataFrame
    documents: DataFrame
    pages: DataFrame
    relevant: DataFrame


def crawl_sites(pages: DataFrame, base_urls: DataFrame | None = None,
                sections: dict[str, list[str]] | None = None, link_keywords: list[str] | None = None,
                prefix: int | None = None, run_ts: str = "1970-01-01 00:00:00",
                coverage_stop: bool = True, content_profile: str = "crawl") -> CrawlOutput:
    """pages(entity, page_id, url, html) -> crawl results per site.

    ``content_profile``: 'crawl' (selector cascade, Python job) or 'region'
    (native first main/article/body region)."""
    sections = vocab.SECTION_KEYWORDS if sections is None else sections
    if content_profile == "region":
        pc = pages.withColumn("content", H.region_text(F.col("html")))
    else:
        content = CT.main_content(pages)
        pc = pages.join(content.select("page_id", "content"), "page_id")
    links = LK.crawlable(LK.extract_links(pages), keywords=link_keywords)
    ps = SC.page_sections(pc, sections=sections, prefix=prefix)
    analysis = SC.analyze_pages(pc, sections=sections)
    la = SC.link_analysis(links, sections)
    urls = pages.select("page_id", "url")
    edges = (la.select("page_id", F.col("url").alias("dst"), "priority")
             .join(urls.withColumnRenamed("url", "src"), "page_id").select("src", "dst", "priority"))
    if base_urls is None:
        base_urls = pages.groupBy("entity").agg(F.min_by("url", "page_id").alias("url"))
    ps_url = ps.join(urls, "page_id").select("url", "section")
    visited = FR.crawl(base_urls, edges,
                       page_sections=ps_url if coverage_stop else None,
                       required=list(sections) if coverage_stop else None)
    meta = pages.select("entity", "page_id", "url", H.title(F.col("html")).alias("title"),
                        H.headings(F.col("html"), 1).alias("h1"), H.headings(F.col("html"), 2, 2).alias("h2"),
                        H.meta_description(F.col("html")).alias("description"))
    docs = SK.crawl_result_documents(visited, analysis, meta, links, la, base_urls, run_ts)
    return CrawlOutput(visited, analysis, links, docs, pages.select("entity", "page_id", "url"),
                       SK.crawl_pages(visited, analysis, meta, links, la))


def rank_sites(crawl: CrawlOutput, keep: list[str] | None = None, skip: list[str] | None = None) -> DataFrame:
    """Links of relevant visited pages, in visit order, ranked per site."""
    rel = (crawl.analysis.where(F.size("relevant_sections") > 0).select("entity", "page_id")
           .join(crawl.pages, ["entity", "page_id"]))
    # a link's place: its page's round, then the page, then the link in the page
    order = crawl.visited.select("entity", "url", "depth").join(rel, ["entity", "url"]).drop("url")
    lk = crawl.links.drop("page_seq").join(order, ["entity", "page_id"])
    lk = lk.withColumn("page_seq", F.struct("depth", "page_id")).drop("depth")
    return LK.rank_links(lk, keep, skip)


def extract_records(ranked: DataFrame, pages: DataFrame, extractor=None, program: dict | None = None):
    """Ranked URLs joined to their pages -> fragments -> merged records.
    Non-web URLs are skipped before any page work."""
    todo = ranked.where(~RC.non_web(F.col("url"))).select("entity", "url", "rank")
    pg = pages.drop("entity").join(todo, "url")
    if extractor is None:
        frags = RC.rule_fragments(pg, seq_col="rank")
    else:
        content = CT.main_content(pg).select("page_id", F.col("dom_content").alias("content"))
        frags = RC.extract_fragments(pg.join(content, "page_id"), extractor)
    merged, items, errors = MG.merge_fragments(frags, TXN.top_keys(program))
    return merged, items, errors


def validate_records(merged: DataFrame, items: DataFrame, pages: DataFrame, accessible: DataFrame | None = None,
                     program: dict | None = None, run_ts: str = "1970-01-01 00:00:00"):
    from sitelens.plans.catalog import record_leaves
    leaves = record_leaves(merged, items)
    pg = pages if accessible is None else pages.join(accessible.where("accessible").select("url"), "url", "left_semi")
    pt = pg.select("entity", "url", "page_seq", H.plain_text(F.col("html")).alias("text"))
    results = VD.validate_fields(leaves, pt, run_ts=run_ts)
    summary = VD.summary(results, ["entity"])
    spark = pages.sparkSession
    sp = spark.createDataFrame(schema_paths(TXN.SAMPLE_PROGRAM if program is None else program),
                               "path array<string>, kind string, ord int")
    issues = VD.structure_issues(sp, merged.select("entity", "path", "kind"))
    report = SK.validation_report(results, summary, run_ts)
    return results, summary, issues, report

