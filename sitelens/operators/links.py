"""Anchor extraction, link filters, per-site de-duplication and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.functions import html, urls
from sitelens.functions.text import any_contains, count_contains


def extract_links(pages: DataFrame) -> DataFrame:
    """pages(entity, page_id, page_seq, url, html) -> one row per ``a[href]``.

    Output: entity, page_id, page_seq, link_seq (0-based among a[href] of the
    page), href, url (resolved against the page URL), text (stripped,
    lower-cased), title (attribute or '')."""
    based = pages.select("entity", "page_id", "page_seq", "html", urls.base_parts(F.col("url")).alias("_base"))
    exploded = based.select(
        "entity", "page_id", "page_seq",
        F.posexplode(html.anchors(F.col("html"), base=F.col("_base"))).alias("link_seq", "a"))
    return exploded.select("entity", "page_id", "page_seq", "link_seq",
                           "a.href", "a.url", "a.text", "a.title")


def crawlable(links: DataFrame, base_domain: F.Column | None = None,
              keywords: list[str] | None = None) -> DataFrame:
    """http(s) link on the start domain, not a document, with a keyword in
    its text or lower-cased URL.  The start domain defaults to the site key."""
    keywords = vocab.CRAWL_LINK_KEYWORDS if keywords is None else keywords
    domain = F.col("entity") if base_domain is None else base_domain
    low_url = F.lower(F.col("url"))
    return links.where(
        F.col("url").startswith("http")
        & (urls.authority(F.col("url")) == domain)
        & ~urls.is_document(F.col("url"), vocab.CRAWL_DOC_EXTENSIONS)
        & (any_contains(F.col("text"), keywords) | any_contains(low_url, keywords)))


def qualify(links: DataFrame, keep: list[str], skip: list[str]) -> DataFrame:
    """F2-F4: non-blank text, no skip substring, at least one keep substring."""
    text = F.lower(F.col("text"))
    return links.where(
        (F.trim(F.col("text")) != "")
        & ~any_contains(text, skip)
        & any_contains(text, keep))


def first_per_url(links: DataFrame) -> DataFrame:
    """W1: first qualifying occurrence of each (entity, url) by (page_seq,
    link_seq).  A min over a struct is a partial aggregate, so a hot URL is
    combined map-side instead of landing whole in one task."""
    first = F.min(F.struct("page_seq", "link_seq", "text")).alias("f")
    return links.groupBy("entity", "url").agg(first).select(
        "entity", "url", "f.page_seq", "f.link_seq", "f.text")


def rank_links(links: DataFrame, keep: list[str] | None = None, skip: list[str] | None = None,
               top: int = vocab.TOP_LINKS, min_score: int | None = None) -> DataFrame:
    """Filter, de-duplicate, score and keep the top links per site.

    Score = number of keep-list entries in the lower-cased text.  Ties keep
    first-seen order.  ``row_number() <= top`` over the site window is planned
    with a partial WindowGroupLimit before the shuffle, so each map task sends
    at most ``top`` rows per site even for a site holding most of the data."""
    keep = vocab.RANK_KEEP_KEYWORDS if keep is None else keep
    skip = vocab.RANK_SKIP_KEYWORDS if skip is None else skip
    firsts = first_per_url(qualify(links, keep, skip))
    scored = firsts.withColumn("relevance_score", count_contains(F.lower(F.col("text")), keep))
    if min_score is not None:   # threshold on relevance (optional)
        scored = scored.where(F.col("relevance_score") >= min_score)
    w = Window.partitionBy("entity").orderBy(F.desc("relevance_score"), "page_seq", "link_seq")
    return (scored.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= top)
            .select("entity", "rank", "url", "text", "relevance_score"))
