"""Writers for the engine's artefacts.

Tables are written partitioned by site with dynamic partition overwrite, so
re-running one site replaces only its partition.  The per-site JSON
documents (crawl result, ranked URLs, record, validation report) are built
as one row per site and written as text; the run timestamp is a parameter so
runs are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.operators.sections import min_priority


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def write_documents(docs: DataFrame, path: str) -> None:
    """docs(entity, json) -> one text file set per site partition."""
    write_table(docs.select("entity", F.col("json").alias("value")), path, ["entity"], fmt="text")


def stamp(run_ts: str) -> F.Column:
    return F.date_format(F.to_timestamp(F.lit(run_ts)), "yyyyMMdd_HHmmss")


def crawl_pages(visited: DataFrame, analysis: DataFrame, pages_meta: DataFrame, links: DataFrame,
                priorities: DataFrame) -> DataFrame:
    """The relevant visited pages (at least one section), a row each, with
    metadata, harvested links and the links of high or medium priority.

    A URL that several pages carry is the page of the smallest id."""
    harvested = (links.groupBy("entity", "page_id")
                 .agg(F.sort_array(F.collect_list(F.struct("link_seq", "url", "text", "title"))).alias("l"))
                 .select("entity", "page_id", F.transform("l", lambda x: F.struct(
                     x["url"].alias("url"), x["text"].alias("text"), x["title"].alias("title"))).alias("link_data")))
    wanted = (min_priority(priorities).groupBy("entity", "page_id")
              .agg(F.sort_array(F.collect_list(F.struct("link_seq", "url"))).alias("l"))
              .select("entity", "page_id", F.transform("l", lambda x: x["url"]).alias("relevant_links")))
    one = pages_meta.groupBy("entity", "url").agg(F.min("page_id").alias("page_id"))
    no_links = F.array().cast("array<struct<url:string,text:string,title:string>>")
    return (visited.join(one, ["entity", "url"]).join(pages_meta.drop("url"), ["entity", "page_id"])
            .join(analysis.where(F.size("relevant_sections") > 0), ["entity", "page_id"])
            .join(harvested, ["entity", "page_id"], "left").join(wanted, ["entity", "page_id"], "left")
            .withColumn("link_data", F.coalesce("link_data", no_links))
            .withColumn("relevant_links", F.coalesce("relevant_links", F.array().cast("array<string>"))))


def crawl_counts(visited: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per site the URLs visited, fetched or not, and the relevant pages."""
    seen = visited.groupBy("entity").agg(F.count(F.lit(1)).alias("total_pages_visited"))
    rel = relevant.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(rel, "entity", "left").select("entity", "total_pages_visited",
                                                   F.coalesce("n", F.lit(0)).alias("relevant_pages_found"))


def crawl_result_documents(visited: DataFrame, analysis: DataFrame, pages_meta: DataFrame, links: DataFrame,
                           priorities: DataFrame, base_urls: DataFrame, run_ts: str) -> DataFrame:
    """Crawl result per site as one JSON document: relevant pages in visit order
    with their metadata and links, and crawl stats.  The document holds a site's
    relevant pages at once; ``crawl_pages`` is the form for any size.

    visited(entity, url, depth); analysis(entity, page_id, relevant_sections);
    pages_meta(entity, page_id, url, title, h1, h2, description);
    links(entity, page_id, link_seq, url, text, title);
    priorities(entity, page_id, link_seq, url, priority); base_urls(entity, url)."""
    pages = crawl_pages(visited, analysis, pages_meta, links, priorities)
    entry = F.struct("url", "relevant_sections", "relevant_links",
                     F.struct("title", "h1", "h2", "description", "link_data").alias("metadata"))
    listed = pages.groupBy("entity").agg(
        F.sort_array(F.collect_list(F.struct("depth", "url", entry.alias("e")))).alias("rel"))
    nothing = F.array().cast(listed.schema["rel"].dataType)
    per_site = (crawl_counts(visited, pages).join(listed, "entity", "left")
                .withColumn("rel", F.coalesce("rel", nothing)))
    entries = F.transform("rel", lambda x: F.struct(x["url"], x["e"]))
    return per_site.join(base_urls.withColumnRenamed("url", "base_url"), "entity", "left").select(
        "entity",
        F.to_json(F.struct(
            F.col("entity").alias("school_name"), "base_url",
            F.map_from_entries(entries).alias("relevant_urls"),
            F.struct("total_pages_visited", "relevant_pages_found", stamp(run_ts).alias("timestamp"))
            .alias("crawl_stats"))).alias("json"))


def ranked_url_documents(ranked: DataFrame, run_ts: str) -> DataFrame:
    """ranked(entity, rank, url, text, relevance_score) -> {school_name, timestamp, urls}."""
    g = ranked.groupBy("entity").agg(F.sort_array(F.collect_list(F.struct("rank", "url", "text", "relevance_score"))).alias("u"))
    return g.select("entity", F.to_json(F.struct(
        F.col("entity").alias("school_name"), stamp(run_ts).alias("timestamp"),
        F.transform("u", lambda x: F.struct(x["url"].alias("url"), x["text"].alias("text"),
                                            x["relevance_score"].alias("relevance_score"))).alias("urls"))).alias("json"))


def report_line() -> F.Column:
    """The block of one result, after an empty line; its source text cut."""
    return F.concat(
        F.lit("\nField: "), F.col("field_path"), F.lit("\nValid: "),
        F.when(F.col("is_valid"), F.lit("True")).otherwise(F.lit("False")),
        F.lit("\nSource URL: "), F.col("url"),
        F.when(F.col("source_text") != "",
               F.concat(F.lit("\nSource text: "), F.substring("source_text", 1, vocab.REPORT_PREFIX), F.lit("...")))
        .otherwise(F.lit("")),
        F.lit("\nNotes: "), F.col("notes"))


def report_head(run_ts: str) -> F.Column:
    """What stands before the results, from a row of the summary."""
    bar = "-" * 80
    head = F.concat(F.lit("Validation Report - "), F.col("entity"), F.lit("\nGenerated: "), F.lit(run_ts),
                    F.lit("\n" + bar + "\n"))
    summ = F.when(F.col("total_fields") > 0, F.concat(
        F.lit("Total fields validated: "), F.col("total_fields").cast("string"),
        F.lit("\nValid fields: "), F.col("valid_fields").cast("string"),
        F.lit("\nInvalid fields: "), F.col("invalid_fields").cast("string"),
        F.lit("\nValidation rate: "), F.format_number(F.col("validation_rate"), 2), F.lit("%"),
        F.lit("\n\nMatch Type Breakdown:\nExact matches: "), F.col("exact_matches").cast("string"),
        F.lit("\nFuzzy matches: "), F.col("fuzzy_matches").cast("string"),
        F.lit("\nNot published fields: "), F.col("not_published").cast("string"))).otherwise(
        F.lit("No fields were validated"))
    return F.concat(head, summ, F.lit("\n" + bar + "\nDetailed Results:"))


def validation_report(results: DataFrame, summary: DataFrame, run_ts: str) -> DataFrame:
    """Text report per site as one value: header, summary block and one block per result
    (page order, then leaf order).  ``report_pieces`` is the form for any size."""
    detail = results.groupBy("entity").agg(
        F.sort_array(F.collect_list(F.struct("page_seq", "ord", "field_path", report_line().alias("line")))).alias("d"))
    j = summary.join(detail, "entity", "left")
    text = F.array_join(F.concat(F.array(report_head(run_ts)),
                                 F.coalesce(F.transform("d", lambda x: x["line"]), F.array().cast("array<string>"))), "\n")
    return j.select("entity", text.alias("json"))


#: The order of the pieces of a report.
REPORT_ORDER = ["body", "page_seq", "ord", "field_path"]


def report_pieces(results: DataFrame, summary: DataFrame, run_ts: str) -> DataFrame:
    """The report as pieces for ``parts.write_parts``: a head, then a piece a result."""
    head = summary.select("entity", F.lit(False).alias("body"), F.lit(None).cast("bigint").alias("page_seq"),
                          F.lit(None).cast("int").alias("ord"), F.lit(None).cast("string").alias("field_path"),
                          report_head(run_ts).alias("value"))
    body = results.select("entity", F.lit(True).alias("body"), F.col("page_seq").cast("bigint").alias("page_seq"),
                          F.col("ord").cast("int").alias("ord"), "field_path", report_line().alias("value"))
    return head.unionByName(body)


def _json_text(c: F.Column) -> F.Column:
    """A string as JSON writes it."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


#: The order of the pieces of a record.
RECORD_ORDER = ["place", "seq", "idx"]


def record_pieces(merged: DataFrame, items: DataFrame) -> DataFrame:
    """Merged records as pieces for ``parts.write_parts``: the JSON text of
    institutions / programs / record, a member or list item a line, indented by two.

    merged(entity, path, kind, value), items(entity, path, seq, idx, kind, value).  Keys
    ascend within their object; an item that is itself an object or a list stays on one
    line.  ``place`` leads a member's own steps by ``k``, its items by ``i`` and its end
    by ``~``, so that places ascend as the text goes.  Only the last member of an object
    and the last item of a list go without a comma: both are one row a parent, found with
    an aggregate and joined by their own unique place, so a parent of very many children
    is no hot key."""
    nodes = merged.select("entity", "path", "kind", "value", F.slice("path", 1, F.size("path") - 1).alias("up"))
    last = nodes.groupBy("entity", "up").agg(F.max("path").alias("path"), F.lit(True).alias("is_last"))
    last_item = (items.groupBy("entity", "path").agg(F.max(F.struct("seq", "idx")).alias("m"))
                 .select("entity", "path", "m.seq", "m.idx", F.lit(True).alias("is_last")))
    filled = (last.select("entity", F.col("up").alias("path")).unionByName(last_item.select("entity", "path"))
              .withColumn("filled", F.lit(True)))
    comma = F.when(F.col("is_last"), "").otherwise(",")

    def scalar() -> F.Column:
        return F.when(F.col("kind") == "string", _json_text(F.col("value"))).otherwise(F.coalesce("value", F.lit("null")))

    nothing = [F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast("int").alias("idx")]
    steps = F.transform("path", lambda k: F.concat(F.lit("k"), k))
    indent = F.repeat(F.lit(" "), 8 + 2 * F.size("path"))
    opening, closing = (F.when(F.col("kind") == "object", o).otherwise(a) for o, a in (("{", "["), ("}", "]")))
    box = F.col("kind").isin("object", "array")
    n = (nodes.join(last.drop("up"), ["entity", "path"], "left").join(filled, ["entity", "path"], "left")
         .select("entity", "path", "kind", "value", "is_last", F.coalesce("filled", F.lit(False)).alias("filled")))
    start = n.select("entity", steps.alias("place"), *nothing, F.concat(
        indent, _json_text(F.element_at("path", -1)), F.lit(": "),
        F.when(box & F.col("filled"), opening).when(box, F.concat(opening, closing, comma))
        .otherwise(F.concat(scalar(), comma))).alias("value"))
    end = n.where(box & F.col("filled")).select("entity", F.concat(steps, F.array(F.lit("~"))).alias("place"), *nothing,
                                                F.concat(indent, closing, comma).alias("value"))
    listed = items.join(last_item, ["entity", "path", "seq", "idx"], "left").select(
        "entity", F.concat(steps, F.array(F.lit("i"))).alias("place"), F.col("seq").cast("bigint").alias("seq"),
        F.col("idx").cast("int").alias("idx"), F.concat(indent, F.lit("  "), scalar(), comma).alias("value"))
    sites = merged.select("entity").distinct()
    head = sites.select("entity", F.array(F.lit("a")).alias("place"), *nothing, F.concat(
        F.lit('{\n  "institutions": [\n    {\n      "institution_name": '), _json_text(F.col("entity")),
        F.lit(',\n      "programs": [\n        {')).alias("value"))
    foot = sites.select("entity", F.array(F.lit("~")).alias("place"), *nothing,
                        F.lit("        }\n      ]\n    }\n  ]\n}").alias("value"))
    return head.unionByName(start).unionByName(listed).unionByName(end).unionByName(foot)


def single_page_result(fragments: DataFrame, url: str, path: str) -> None:
    """Extraction result of one page (a pushed-down equality filter on the
    source URL), written as JSON text."""
    one = fragments.where(F.col("source_url") == url).select(F.col("json").alias("value"))
    # a shuffle, so that the extractor above keeps its own parallelism
    one.repartition(1).write.mode("overwrite").text(path)
