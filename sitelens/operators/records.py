"""Per-page JSON fragments: prompt payloads, the extractor hook, and the
rule extractor used by the query registry.

The extractor is a user batch function run with ``mapInPandas`` (a model
client, say) that maps (entity, seq, url, title, content) batches to
(entity, seq, json).  ``rule_fragments`` is a deterministic stand-in that
derives a fragment from page fields only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.functions import html as H
from sitelens.functions.text import left_chars

ExtractorFn = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
FRAGMENT_SCHEMA = "entity string, seq bigint, source_url string, json string"

LANG_RE = "(?is)<html\\b[^>]*\\slang\\s*=\\s*\"([^\"]*)\""


def rule_fragments(pages: DataFrame, seq_col: str = "page_id") -> DataFrame:
    """pages(entity, <seq_col>, url, html) -> fragments(entity, seq, source_url, json):
    {"title": .., "lang": .., "tags": [anchor texts], "stats": {"anchors": n}}.
    ``seq_col`` orders the fragments for the merge (ranked URL order in the
    extraction stage)."""
    a = H.anchors(F.col("html"))
    tags = F.transform(a, lambda x: x["text"])
    doc = F.struct(F.coalesce(H.title(F.col("html")), F.lit("")).alias("title"),
                   F.regexp_extract("html", LANG_RE, 1).alias("lang"),
                   tags.alias("tags"),
                   F.struct(F.size(a).alias("anchors")).alias("stats"))
    return pages.select("entity", F.col(seq_col).cast("bigint").alias("seq"), F.col("url").alias("source_url"),
                        F.to_json(doc).alias("json"))


def extract_fragments(pages: DataFrame, extractor: ExtractorFn, content: str = "content",
                      concurrency: int | None = None, schema_section: str | None = None) -> DataFrame:
    """Run a user extractor over (entity, seq, url, title, content,
    schema_section, batch_no) batches.  ``concurrency`` bounds the number of
    simultaneous extractor tasks (the model's rate limit), in place of fixed
    batches of three pages; ``batch_no`` = (rank - 1) div 3 is kept for
    audit.  ``schema_section`` asks the extractor for one section only."""
    seq = F.col("rank") if "rank" in pages.columns else F.col("page_id")
    src = pages.select("entity", seq.cast("bigint").alias("seq"), "url",
                       H.title(F.col("html")).alias("title"), F.col(content).alias("content"),
                       F.lit(schema_section).cast("string").alias("schema_section"),
                       F.floor((seq - 1) / vocab.EXTRACT_BATCH).cast("bigint").alias("batch_no"))
    # pages without content never reach the extractor
    src = src.where(F.col("content").isNotNull() & (F.col("content") != ""))
    if concurrency:
        src = src.repartition(concurrency)
    return src.mapInPandas(extractor, FRAGMENT_SCHEMA)


def non_web(url_col, extensions: list[str] | None = None):
    """Lower-cased URL contains a document extension (skipped before load)."""
    from sitelens.functions.text import any_contains
    return any_contains(F.lower(url_col), vocab.EXTRACT_DOC_EXTENSIONS if extensions is None else extensions)


def is_html(content_type) -> F.Column:
    """Content-type test before extraction: the header must start with
    'text/html'; a missing header counts as '' and is rejected."""
    return F.coalesce(content_type, F.lit("")).startswith("text/html")


def prompt_payloads(pages: DataFrame, links: DataFrame, section_names: list[str],
                    prefix: int | None = None) -> DataFrame:
    """One prompt payload per page: url, headings (h1, first two h2), content
    (whole; ``prefix`` cuts it to so many code points, ``vocab.CONTENT_PREFIX``
    being the crawler's number) and links with non-blank text; plus the token estimate of
    system + user text (characters // 4)."""
    lk = (links.where(F.trim("text") != "")
          .groupBy("entity", "page_id")
          .agg(F.sort_array(F.collect_list(F.struct("link_seq", "text", "url"))).alias("l")))
    content = F.col("content") if prefix is None else left_chars(F.col("content"), prefix)
    p = pages.select("entity", "page_id", "url", H.headings(F.col("html"), 1).alias("h1"),
                     H.headings(F.col("html"), 2, 2).alias("h2"), F.coalesce(content, F.lit("")).alias("content"))
    j = p.join(lk, ["entity", "page_id"], "left")
    payload = F.to_json(F.struct(
        "url", F.struct("h1", "h2").alias("headings"), "content",
        F.coalesce(F.transform("l", lambda x: F.struct(x["text"].alias("text"), x["url"].alias("url"))),
                   F.array().cast("array<struct<text:string,url:string>>")).alias("links")))
    system = ("Classify page content into these taxonomy sections and rank its links: "
              + ", ".join(section_names))
    est = F.floor((F.lit(len(system)) + F.length(payload)) / vocab.CHARS_PER_TOKEN).cast("bigint")
    return j.select("entity", "page_id", payload.alias("payload"), est.alias("est_tokens"))
