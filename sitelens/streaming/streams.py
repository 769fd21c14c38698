"""Structured Streaming forms of the incremental loops.

* ``new_url_stream``: links of arriving pages, de-duplicated on (entity, url)
  for ever (the crawler's visited set); ``within_watermark=True`` bounds the
  state with ``dropDuplicatesWithinWatermark`` (an old URL may be re-admitted
  once it falls behind the watermark).
* ``usage_session_stream``: calls grouped into gap sessions per caller with
  ``session_window`` under a watermark; sessions are emitted once closed
  (append mode).  A call exactly one gap after the last one still belongs to its
  session, as in the batch form.
* ``run_page_sections``: stateless page -> section rows, published per micro-batch
  as a version of a ``SnapshotStore``: a batch that is replayed changes nothing.

All sinks and checkpoints live below the session's checkpoint folder; tests
and the registry drive them with ``trigger(availableNow=True)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.urls import authority
from sitelens.operators import links as LK
from sitelens.operators import sections as SC
from sitelens.operators import usage as US
from sitelens.session import scratch_dir
from sitelens.sources.snapshots import SnapshotStore
from sitelens.sources.tables import spread


def _run(df: DataFrame, out: str, mode: str = "append", fmt: str = "parquet") -> None:
    q = (df.writeStream.format(fmt).outputMode(mode)
         .option("path", out).option("checkpointLocation", out + "-ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _read_dir(reader, path: str) -> DataFrame:
    """File streams list directories; a single-file table is streamed from its
    folder with a file-name filter."""
    import os
    if path.endswith(".parquet") and not os.path.isdir(path):
        folder, name = os.path.split(path)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def stream_pages(spark: SparkSession, path: str, schema: str = "page_id bigint, url string, html string",
                 max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = spread(_read_dir(r, path), "page_id", "url")
    return df.select("page_id", "url", "html", authority(F.col("url")).alias("entity"),
                     F.col("page_id").alias("page_seq"))


def new_url_stream(pages_stream: DataFrame, within_watermark: str | None = None) -> DataFrame:
    links = LK.extract_links(pages_stream).select("entity", "url", "page_id", "link_seq")
    if within_watermark:
        links = links.withColumn("seen_at", F.current_timestamp()).withWatermark("seen_at", within_watermark)
        return links.dropDuplicatesWithinWatermark(["entity", "url"])
    return links.dropDuplicates(["entity", "url"])


def _sessions(calls: DataFrame, gap: str) -> DataFrame:
    c = calls.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))
    return (c.groupBy("caller", F.session_window("ts", gap).alias("s"))
            .agg(F.count("*").alias("n_calls"), F.sum("total_tokens").alias("tokens"))
            .select("caller", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n_calls", "tokens"))


def usage_session_stream(calls_stream: DataFrame, gap: str, watermark: str = "5 minutes") -> DataFrame:
    """Sessions that the watermark has closed."""
    return _sessions(calls_stream.withWatermark("ts", watermark), gap)


def open_sessions(calls: DataFrame, closed: DataFrame, gap: str) -> DataFrame:
    """Sessions of an exhausted input that no watermark can close any more: those
    of each caller's calls from the end of its last closed session on."""
    ends = closed.groupBy(F.col("caller").alias("c")).agg(F.max("session_end").alias("end"))
    rest = calls.join(ends, F.col("caller").eqNullSafe(F.col("c")), "left")
    return _sessions(rest.where(F.col("end").isNull() | (F.col("ts") > F.col("end"))).drop("c", "end"), gap)


def run_new_urls(spark: SparkSession, pages_path: str) -> DataFrame:
    out = scratch_dir(spark, "stream-new-urls")
    _run(new_url_stream(stream_pages(spark, pages_path)), out)
    return spark.read.parquet(out)


def run_usage_sessions(spark: SparkSession, events_path: str, gap: str) -> DataFrame:
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ev = _read_dir(spark.readStream.schema(schema), events_path)
    out = scratch_dir(spark, "stream-usage")
    _run(usage_session_stream(US.calls_from_events(ev), gap), out)
    closed = spark.read.parquet(out)
    # the input has ended: what is still open is complete as well
    calls = US.calls_from_events(spark.read.schema(schema).parquet(events_path))
    return closed.unionByName(open_sessions(calls, closed, gap))


def publish_batches(stream: DataFrame, make, store: SnapshotStore, checkpoint: str) -> None:
    """Runs ``make(batch)`` on every micro-batch and publishes its rows under the batch
    number.  A batch that is replayed after a failure, whether before or after its
    rows were published, is in the store once."""
    q = (stream.writeStream.foreachBatch(lambda batch, epoch: store.save(epoch, make(batch)) and None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_page_sections(spark: SparkSession, pages_path: str, sections: dict[str, list[str]],
                      content_fn, max_files: int | None = None) -> DataFrame:
    out = scratch_dir(spark, "stream-sections")
    store = SnapshotStore(spark, out)

    def found(batch: DataFrame) -> DataFrame:
        pg = batch.select("entity", "page_id", content_fn(F.col("html")).alias("content"))
        return SC.page_sections(pg, sections=sections)

    publish_batches(stream_pages(spark, pages_path, max_files=max_files), found, store, out + "-ckpt")
    return store.read()
