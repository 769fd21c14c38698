"""Section classification of pages and links (the rule analyzer) and the
pluggable model hook.

The rule analyzer counts, per section, how many of its keywords occur in the
lower-cased page content prefix; confidence is ``least(0.9, hits * 0.3)``.
A link is emitted with priority ``high`` and score 0.8 when its text holds a
keyword of some section; other links are not emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.functions.text import any_contains, count_contains, left_chars


def _section_hits(text: Column, sections: dict[str, list[str]]) -> Column:
    return F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("section_ord"),
                 count_contains(text, kws).alias("hits"))
        for i, (s, kws) in enumerate(sections.items())])


def confidence(hits: Column) -> Column:
    return F.least(F.lit(vocab.CONFIDENCE_CAP), hits.cast("double") * F.lit(vocab.CONFIDENCE_STEP))


def page_sections(pages: DataFrame, content: str = "content",
                  sections: dict[str, list[str]] | None = None,
                  prefix: int | None = None) -> DataFrame:
    """pages(entity, page_id, <content>) -> (entity, page_id, section,
    section_ord, hits, confidence) for sections with at least one hit.

    ``prefix`` cuts the content to its first code points before matching
    (500 reproduces the crawler's payload cut); None matches whole texts."""
    sections = vocab.SECTION_KEYWORDS if sections is None else sections
    text = F.col(content) if prefix is None else left_chars(F.col(content), prefix)
    low = pages.select("entity", "page_id", F.lower(text).alias("_low"))
    hits = low.select("entity", "page_id", F.explode(_section_hits(F.col("_low"), sections)).alias("h"))
    return (hits.where(F.col("h.hits") > 0)
            .select("entity", "page_id", "h.section", "h.section_ord", "h.hits",
                    confidence(F.col("h.hits")).alias("confidence")))


def link_analysis(links: DataFrame, sections: dict[str, list[str]] | None = None) -> DataFrame:
    """links(entity, page_id, link_seq, url, text) -> emitted links with
    priority 'high', relevance 0.8 and the expected sections in taxonomy
    order.  Links with blank text are not part of the payload."""
    sections = vocab.SECTION_KEYWORDS if sections is None else sections
    low = F.lower(F.col("text"))
    expected = F.filter(F.array(*[F.when(any_contains(low, kws), F.lit(s)) for s, kws in sections.items()]),
                        lambda s: s.isNotNull())
    out = links.where(F.trim(F.col("text")) != "").select(
        "entity", "page_id", "link_seq", "url", expected.alias("expected_content"))
    return (out.where(F.size("expected_content") > 0)
            .select("entity", "page_id", "link_seq", "url",
                    F.lit(vocab.LINK_RELEVANCE).alias("relevance_score"),
                    F.lit("high").alias("priority"), "expected_content"))


PRIORITIES = ("high", "medium", "low")


def min_priority(links: DataFrame, least: str = "medium") -> DataFrame:
    """links whose priority is at least ``least``; unknown priorities go."""
    return links.where(F.col("priority").isin(*PRIORITIES[:PRIORITIES.index(least) + 1]))


def page_category(sections_df: DataFrame) -> DataFrame:
    """One category per page: highest confidence, ties to taxonomy order."""
    key = F.struct(F.col("confidence"), (-F.col("section_ord")).alias("neg_ord"))
    return sections_df.groupBy("entity", "page_id").agg(
        F.max_by("section", key).alias("category"), F.max("confidence").alias("confidence"))


def coverage(sections_df: DataFrame, sites: DataFrame,
             sections: dict[str, list[str]] | None = None) -> DataFrame:
    """Per site: found sections (union over relevant pages), the required
    ones still missing, and whether found covers required."""
    sections = vocab.SECTION_KEYWORDS if sections is None else sections
    required = F.array(*[F.lit(s) for s in sections])
    found = sections_df.groupBy("entity").agg(F.array_sort(F.collect_set("section")).alias("found"))
    cov = sites.select("entity").distinct().join(found, "entity", "left").select(
        "entity", F.coalesce("found", F.array().cast("array<string>")).alias("found"))
    missing = F.array_sort(F.array_except(required, F.col("found")))
    return cov.select("entity", "found", missing.alias("missing"),
                      F.size("found").alias("n_found"), F.lit(len(sections)).alias("n_required"),
                      (F.size(missing) == 0).alias("complete"))


def coverage_gaps(sections_df: DataFrame, sites: DataFrame,
                  sections: dict[str, list[str]] | None = None) -> DataFrame:
    """Required section x site, minus what was found (left anti join); the
    section table is a literal of bounded size, hence broadcast."""
    sections = vocab.SECTION_KEYWORDS if sections is None else sections
    spark = sites.sparkSession
    req = spark.createDataFrame([(s, i) for i, s in enumerate(sections)], "section string, section_ord int")
    want = sites.select("entity").distinct().crossJoin(F.broadcast(req))
    have = sections_df.select("entity", "section").distinct()
    return want.join(have, ["entity", "section"], "left_anti")


AnalyzerFn = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
ANALYSIS_SCHEMA = ("entity string, page_id bigint, relevant_sections array<string>, "
                   "section_confidence map<string,double>")


def analyze_pages(pages: DataFrame, analyzer: AnalyzerFn | None = None, content: str = "content",
                  sections: dict[str, list[str]] | None = None) -> DataFrame:
    """Page analysis as one row per page.  ``analyzer`` is a user batch
    function (e.g. a model client) run with ``mapInPandas``; it receives
    (entity, page_id, url, content) batches and returns ``ANALYSIS_SCHEMA``.
    Without one, the rule analyzer runs as plain Column expressions."""
    if analyzer is not None:
        return pages.select("entity", "page_id", "url", content).mapInPandas(analyzer, ANALYSIS_SCHEMA)
    hits = page_sections(pages, content, sections)
    agg = hits.groupBy("entity", "page_id").agg(
        F.array_sort(F.collect_list(F.struct("section_ord", "section", "confidence"))).alias("s"))
    analysed = agg.select("entity", "page_id",
                          F.transform("s", lambda x: x["section"]).alias("relevant_sections"),
                          F.map_from_entries(F.transform("s", lambda x: F.struct(x["section"], x["confidence"])))
                          .alias("section_confidence"))
    empty = pages.select("entity", "page_id").join(analysed, ["entity", "page_id"], "left_anti").select(
        "entity", "page_id", F.array().cast("array<string>").alias("relevant_sections"),
        F.create_map().cast("map<string,double>").alias("section_confidence"))
    return analysed.unionByName(empty)

