"""Members of one object or list inside JSON documents of any size.

A plain JSON reader holds a document in one row.  Here the text source reads it in
splits, a record being what stands between two double quotes; no line structure is needed.
A quote ends or begins a string unless the record before it ends with an odd number of
backslashes, and outside strings JSON has no backslash.  So the number of such quotes
before a record tells by its parity whether the record lies in a string; outside
strings, the brackets before a token give its depth, and the commas of one depth within a
container its member.  All three are prefix sums: a window inside each split, and offsets
from one small row a split.  A row holds one record or one member, never a document.

Documents must be valid JSON (``tables.json_documents`` tells which are).  What bounds a record is
the quotes: a run of numbers without any quote is one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.session import scratch_dir

_KEY = r'^"([^"\\]*+(?:\\.[^"\\]*+)*+)"\s*+:\s*+'


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "json-tokens")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _sum_before(df: DataFrame, keys: list[str], block: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the document's rows before this one.  ``df`` is a stored
    table; a block is one split of a file."""
    df = df.withColumn("_value", value.cast("long"))
    inside = Window.partitionBy(*keys, *block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (df.groupBy(*keys, *block).agg(F.sum("_value").alias("_sum"))
              .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum"))
    return (df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
            .join(blocks, [*keys, *block]).withColumn(name, F.col("_offset") + F.col("_inside"))
            .drop("_value", "_inside", "_offset"))


def _records(spark: SparkSession, path: str, partitions: T.StructType, part: str | None):
    """The records between quotes and the names of their document and of their place."""
    raw = (spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *partitions]))
           .option("lineSep", '"').text(path))
    columns = [F.coalesce(f.name, F.lit("")).alias(f.name) if f.dataType == T.StringType() else F.col(f.name)
               for f in partitions]
    rows = _stored(raw.select(F.col("_metadata.file_path").alias("file"), *columns,
                              F.col("_metadata.file_block_start").alias("start"),
                              F.monotonically_increasing_id().alias("id"), "value"))
    own = [f.name for f in partitions if f.name != part]
    keys, block = (own, [part, "start"]) if part else (["file", *own], ["start"])
    # no quote follows the last record of a file
    ends = rows.groupBy("file").agg(F.max(F.struct("start", "id")).alias("m")).select(
        "file", "m.start", "m.id", F.lit(True).alias("is_end"))
    return rows.join(ends, ["file", "start", "id"], "left"), keys, block


def json_members(spark: SparkSession, path: str, at: list[str | int], partitions: T.StructType | None = None,
                 part: str | None = None) -> DataFrame:
    """The members of the container at ``at`` (keys, or places in a list) of every document
    below ``path``: file or partition columns, idx (from 0), key (null in a list), json.

    A file is a document; with ``part``, a partition column, the files of equal other
    partition columns are one document, in the order of ``part``.  Of a key given twice the
    last counts, on the way as in the result's ``idx``; a document without the container, or with
    a scalar there, gives no row."""
    rows, keys, block = _records(spark, path, partitions or T.StructType([]), part)
    end = F.coalesce("is_end", F.lit(False))
    escaped = F.pmod(F.length("value") - F.length(F.rtrim(F.col("value"), F.lit("\\"))), F.lit(2)) == 1
    rows = _sum_before(_stored(rows.select(*keys, *block, "id", "value", end.alias("is_end"))), keys, block, ["id"],
                       F.when(end | escaped, 0).otherwise(1), "quotes")
    outside = F.pmod(F.col("quotes"), F.lit(2)) == 0
    quote = F.when(F.col("is_end"), "").otherwise('"')
    tokens = (rows.select(*keys, *block, "id", outside.alias("outside"), F.posexplode(
        F.when(outside, F.concat(F.regexp_extract_all("value", F.lit(r"([\[\]{},]|[^\[\]{},]+)"), F.lit(1)), F.array(quote)))
        .otherwise(F.array(F.concat("value", quote)))).alias("pos", "token"))
        .withColumn("step", F.when(F.col("outside") & F.col("token").isin("{", "["), 1)
                    .when(F.col("outside") & F.col("token").isin("}", "]"), -1).otherwise(0)))
    order = ["id", "pos"]
    tokens = _sum_before(_stored(tokens), keys, block, order, F.col("step"), "depth")
    for level, wanted in enumerate([*at, None], start=1):
        comma = F.col("outside") & (F.col("token") == ",") & (F.col("depth") == level)
        inside = tokens.where((F.col("depth") >= level) & (F.col("depth") + F.col("step") >= level))
        tokens = _stored(_sum_before(_stored(inside), keys, block, order, comma.cast("int"), "idx").where(~comma))
        if wanted is None:
            break
        if isinstance(wanted, int):
            tokens = tokens.where(F.col("idx") == wanted).drop("idx")
            continue
        # what a member holds beside inner containers: its key and a scalar at most
        own = _text(tokens.where(F.col("depth") == level), keys, block, order)
        member = (own.where(_key(F.col("text")) == wanted).groupBy(*keys).agg(F.max("idx").alias("idx")))
        tokens = tokens.join(_stored(member), [*keys, "idx"]).drop("idx")
    members = _text(tokens, keys, block, order).where("text != ''")
    return members.select(*keys, "idx", _key(F.col("text")).alias("key"), F.regexp_replace("text", _KEY, "").alias("json"))


def _text(tokens: DataFrame, keys: list[str], block: list[str], order: list[str]) -> DataFrame:
    listed = F.sort_array(F.collect_list(F.struct(*block, *order, "token")))
    return (tokens.groupBy(*keys, "idx").agg(listed.alias("t"))
            .select(*keys, "idx", F.regexp_replace(F.array_join(F.transform("t", lambda x: x["token"]), ""),
                                                   r"^\s++|\s++$", "").alias("text")))


def _key(text: Column) -> Column:
    """The key that a member begins with, decoded; null in a list."""
    written = F.concat(F.lit('["'), F.regexp_extract(text, _KEY, 1), F.lit('"]'))
    return F.when(text.rlike(_KEY), F.element_at(F.from_json(written, "array<string>"), 1))


def crawl_result_links(spark: SparkSession, path: str, partitions: T.StructType) -> DataFrame:
    """``tables.crawl_result_links`` for documents of any size: partition columns, page_seq,
    link_seq, url, text, title; a row holds a page."""
    from sitelens.sources.tables import CRAWL_RESULT_SCHEMA
    names = [f.name for f in partitions]
    page = CRAWL_RESULT_SCHEMA["relevant_urls"].dataType.valueType
    pages = json_members(spark, path, ["relevant_urls"], partitions).select(
        *names, F.col("idx").alias("page_seq"), F.from_json("json", page).alias("page"))
    return (pages.select(*names, "page_seq", F.posexplode("page.metadata.link_data").alias("link_seq", "link"))
            .select(*names, "page_seq", "link_seq", "link.url", "link.text", F.coalesce("link.title", F.lit("")).alias("title")))
