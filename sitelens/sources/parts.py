"""Documents of any size, written in ordered parts.

A document is given as pieces: rows of (entity, order columns, value).  Pieces are
dealt out by range over (entity, order), so that a document of many pieces spans many
tasks and a task holds pieces of many small ones; each task writes the part of every
document it holds to a file of its own, ``entity=<entity>/split=<number>``.  No task
sees more than its range, however large a document is.  Splits ascend with the
order, so the files of a document, joined in that order, are the document; each piece
ends with a line feed.  An entity that is null or empty is the empty one.

The list of parts (number, length and offset in the document) comes from the files' own
lengths.  It is written last: a reader that follows it reads no unfinished document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.session import scratch_dir, stored

#: Pieces of one part, about: ranges come from a sample.
PIECES_PER_PART = 200_000

#: A caller may ask for smaller parts, up to this number of parts; documents that would
#: take more get larger parts, as a task and a file a few pieces cost more than they hold.
SMALL_PARTS = 64

PARTITIONS = T.StructType([T.StructField("entity", T.StringType()), T.StructField("split", T.LongType())])

_LIST = "entity string, part long, split long, n_bytes long, offset long"


def write_parts(pieces: DataFrame, order: list[str], root: str, pieces_per_part: int = PIECES_PER_PART) -> DataFrame:
    """pieces(entity, ``order``, value) -> files below ``root``; the list of parts.

    ``order`` is a total order within an entity.  ``root`` must be new: a run has a folder
    of its own, as its documents have a timestamp."""
    spark = pieces.sparkSession
    path = scratch_dir(spark, "pieces")
    # counted, sampled and written from one stored copy
    pieces.select(F.coalesce("entity", F.lit("")).alias("entity"), *order, "value").write.parquet(path)
    rows = spark.read.parquet(path)
    n = parts_of(rows.count(), pieces_per_part)
    if not n:       # no files, of which a reader could tell the columns
        spark.createDataFrame([], _LIST).write.parquet(f"{root}/list")
        return part_list(spark, root)
    dealt(rows, order, n).write.partitionBy("entity", "split").text(f"{root}/parts")
    files = (spark.read.format("binaryFile").schema(T.StructType([
        T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()), *PARTITIONS]))
        .load(f"{root}/parts").select(F.coalesce("entity", F.lit("")).alias("entity"), "split", "length"))
    before = Window.partitionBy("entity").orderBy("split")       # one small row a part
    (files.select("entity", (F.row_number().over(before) - 1).cast("long").alias("part"), "split", F.col("length").alias("n_bytes"),
                  (F.sum("length").over(before) - F.col("length")).alias("offset"))
     .write.parquet(f"{root}/list"))
    return part_list(spark, root)


def parts_of(n_pieces: int, pieces_per_part: int) -> int:
    """How many parts: as asked for up to ``SMALL_PARTS``, then of PIECES_PER_PART pieces."""
    return max(min(-(-n_pieces // pieces_per_part), SMALL_PARTS), -(-n_pieces // max(pieces_per_part, PIECES_PER_PART)))


def dealt(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """entity, split, value in ``n`` ranges, each sorted.  The entity is given as never
    null: the writer would else replace it and sort anew, by entity and split alone."""
    return (rows.withColumn("entity", F.coalesce("entity", F.lit("")))
            .repartitionByRange(n, "entity", *order)
            .withColumn("split", F.spark_partition_id().cast("long"))
            .sortWithinPartitions("entity", "split", *order).select("entity", "split", "value"))


def part_list(spark: SparkSession, root: str) -> DataFrame:
    """entity, part (from 0), split, n_bytes, offset (bytes of the parts before)."""
    return spark.read.schema(_LIST).parquet(f"{root}/list")


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    """entity, part, text: joined by part, the texts are the document."""
    if part_list(spark, root).isEmpty():
        return spark.createDataFrame([], "entity string, part long, text string")
    schema = T.StructType([T.StructField("value", T.StringType()), *PARTITIONS])
    texts = (spark.read.schema(schema).text(f"{root}/parts", wholetext=True)
             .select(F.coalesce("entity", F.lit("")).alias("entity"), "split", F.col("value").alias("text")))
    return texts.join(part_list(spark, root), ["entity", "split"]).select("entity", "part", "text")


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """entity, line (from 0 within the document), text; a part's lines follow those of
    the parts before it.

    The text source reads the files in splits, a row being a line: no part is held in a row, whatever its
    size.  A line's number is its place in its split, and the lines of the splits and parts before."""
    listed = part_list(spark, root)
    if listed.isEmpty():
        return spark.createDataFrame([], "entity string, line long, text string")
    raw = (spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *PARTITIONS]))
           .option("lineSep", "\n").text(f"{root}/parts"))
    block = ["entity", "split", "start"]
    # counted and numbered from one stored copy, which fixes the ids
    lines = stored(raw.select(F.coalesce("entity", F.lit("")).alias("entity"), "split",
                              F.col("_metadata.file_block_start").alias("start"),
                              F.monotonically_increasing_id().alias("id"), F.col("value").alias("text")), "lines")
    part = Window.partitionBy("entity", "split")
    before = Window.partitionBy("entity").orderBy("split", "start").rowsBetween(Window.unboundedPreceding, -1)
    # one small row a split of a file; of a file's first bytes the text source drops a byte order mark
    blocks = stored(
        lines.groupBy(*block).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"),
                                  F.sum(F.octet_length("text") + 1).alias("read"))
        .join(listed.select("entity", "split", "n_bytes"), ["entity", "split"])
        .select(*block, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                ((F.col("start") == 0) & (F.sum("read").over(part) < F.col("n_bytes"))).alias("marked")), "line-blocks")
    mark = F.when(F.col("marked") & (F.col("id") == F.col("first")), "\ufeff").otherwise("")
    return lines.join(blocks, block).select("entity", (F.col("offset") + F.col("id") - F.col("first")).alias("line"),
                                            F.concat(mark, "text").alias("text"))
