"""Rows of a file whose splits hold them unevenly are dealt out before per-row work."""

from pyspark.sql import functions as F

from sitelens.sources.tables import pages, spread
from sitelens.streaming import streams as ST


def _one_row_group(spark, path, rows=400):
    """One file of one row group that the session reads in many splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    (spark.range(rows).coalesce(1).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("page_id"),          # half of the ids are null
        F.concat(F.lit("http://a.example/"), "id").alias("url"),
        F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"/{k}")), 512) for k in range(12)]).alias("html"))
     .write.parquet(path))


def _most(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_one_row_group_is_dealt_out(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        _one_row_group(spark, f"{tmp_path}/pages.parquet")
        read = spark.read.parquet(f"{tmp_path}/pages.parquet")
        assert read.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and _most(read) == 400
        assert _most(spread(read, "page_id", "url")) < 100
        assert _most(pages(spark, str(tmp_path))) < 100
        assert pages(spark, str(tmp_path)).count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_streamed_pages_are_dealt_out(spark, tmp_path):
    _one_row_group(spark, f"{tmp_path}/in")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    seen = []
    stream = ST.stream_pages(spark, f"{tmp_path}/in")
    (stream.writeStream.foreachBatch(lambda batch, epoch: seen.append((batch.count(), _most(batch))))
     .option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start().awaitTermination())
    assert sum(n for n, _ in seen) == 400 and max(m for _, m in seen) < 300


def test_documents_are_dealt_out_before_they_are_hashed(spark, tmp_path):
    from sitelens.plans import catalog
    spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.distinct_documents(spark, str(tmp_path))
    assert {r.doc_id for r in found.collect()} == {1, 3}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2        # both readings of the texts
