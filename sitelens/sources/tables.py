"""Readers for the input tables and the engine's JSON artefacts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.functions.urls import authority

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Tasks that one split of the scan is dealt out to.
TASKS_PER_SPLIT = 4


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Per-row CPU-heavy inputs (HTML, long texts) are dealt out by hash before that
    work.  A scan's splits don't tell how its rows lie: a row group is read by the one
    split that holds its middle, so a large file of one row group has many splits and all
    its rows in one task.  The number of tasks grows with the scan's splits, which grow
    with the files, so a task's share stays bounded.  Name several ``keys``: rows whose
    first key is null or repeats then still spread."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = want if df.isStreaming else df.rdd.getNumPartitions()
    except Exception:          # no classic context: leave the plan as it is
        return df
    return df.repartition(max(want, have * TASKS_PER_SPLIT), *keys)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages with the site key (``entity``) and a stable page order.

    The entity is the URL authority (``urlparse().netloc``); page order is the
    page id, which stands for the order pages entered the crawl result."""
    df = spread(table(spark, sf_dir, "pages"), "page_id", "url")
    return df.select("page_id", "url", "html",
                     authority(F.col("url")).alias("entity"),
                     F.col("page_id").alias("page_seq"))


CRAWL_RESULT_SCHEMA = T.StructType([
    T.StructField("school_name", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("relevant_urls", T.MapType(T.StringType(), T.StructType([
        T.StructField("url", T.StringType()),
        T.StructField("relevant_sections", T.ArrayType(T.StringType())),
        T.StructField("relevant_links", T.ArrayType(T.StringType())),
        T.StructField("metadata", T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("h1", T.ArrayType(T.StringType())),
            T.StructField("h2", T.ArrayType(T.StringType())),
            T.StructField("description", T.StringType()),
            T.StructField("link_data", T.ArrayType(T.StructType([
                T.StructField("url", T.StringType()),
                T.StructField("text", T.StringType()),
                T.StructField("title", T.StringType()),
            ]))),
        ])),
    ]))),
    T.StructField("crawl_stats", T.StructType([
        T.StructField("total_pages_visited", T.LongType()),
        T.StructField("relevant_pages_found", T.LongType()),
        T.StructField("timestamp", T.StringType()),
    ])),
])


def crawl_result_links(spark: SparkSession, path: str) -> DataFrame:
    """Crawl-result JSON files -> one row per harvested link, in stored order.

    Pages without ``metadata.link_data`` contribute nothing.  JSON objects
    keep their key order when read into a map, so ``posexplode`` over the map
    entries yields the page order of the file."""
    raw = spark.read.schema(CRAWL_RESULT_SCHEMA).json(path, multiLine=True)
    pages_ = raw.select(F.col("school_name").alias("entity"),
                        F.posexplode(F.map_entries("relevant_urls")).alias("page_seq", "page"))
    links = pages_.where(F.col("page.value.metadata.link_data").isNotNull()).select(
        "entity", "page_seq", F.posexplode("page.value.metadata.link_data").alias("link_seq", "link"))
    return links.select("entity", "page_seq", "link_seq",
                        F.col("link.url").alias("url"), F.col("link.text").alias("text"),
                        F.coalesce(F.col("link.title"), F.lit("")).alias("title"))


def ranked_urls(spark: SparkSession, path: str) -> DataFrame:
    """Ranked-URL JSON files -> (entity, rank, url, text, relevance_score)."""
    schema = "school_name string, timestamp string, urls array<struct<url:string,text:string,relevance_score:int>>"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    return raw.select(F.col("school_name").alias("entity"),
                      F.posexplode("urls").alias("pos", "u")).select(
        "entity", (F.col("pos") + 1).alias("rank"), "u.url", "u.text", "u.relevance_score")


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """Text file, one URL per line, stripped; blank lines kept as ''."""
    from sitelens.functions.text import strip_ws
    df = spark.read.text(path)
    return df.select(strip_ws(F.col("value")).alias("url"))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents (one per file) as (path, json, doc variant)."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.input_file_name().alias("path"), F.col("value").alias("json"),
                     F.try_parse_json("value").alias("doc"))


def taxonomy_program(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy file -> its first program (the record schema), failing loudly
    when ``institutions`` or ``programs`` is missing or empty."""
    docs = json_documents(spark, path)
    inst = F.variant_get("doc", "$.institutions[0]", "variant")
    prog = F.variant_get("doc", "$.institutions[0].programs[0]", "variant")
    checked = F.when(inst.isNull(), F.raise_error(F.lit("Invalid taxonomy: missing 'institutions' key"))) \
        .when(prog.isNull(), F.raise_error(F.lit("Invalid taxonomy: missing 'programs' key"))) \
        .otherwise(F.to_json(prog))
    return docs.select(checked.alias("program_json"))
