"""Reachability of a link graph whose pages arrive in any order.

Links come in micro-batches.  Two stored states grow with them: the links seen, a
version a batch, and the depths found, a version a batch that holds the URLs whose
depth got smaller.  A batch's links are followed from the URLs reached so far; every
URL that is new, or reached on a shorter way than before, is followed again over all
links, round by round, until nothing improves.  So a page that arrives late connects
what hung on it, and a short cut that arrives late shortens all depths behind it: in
the end the depths are those of one crawl over the whole graph.

Versions are published by batch number (``SnapshotStore``), and a batch reads the
versions before its own only; a batch that is replayed gives the same and is kept once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.session import scratch_dir, stored
from sitelens.sources.snapshots import SnapshotStore


#: Rounds of one batch that are read one by one.
COMPACT_EVERY = 16


class ReachState:
    """seeds(entity, url); links(src, dst) belong to the sites whose URLs reach them."""

    def __init__(self, spark: SparkSession, root: str, seeds: DataFrame):
        self.spark = spark
        self.links = SnapshotStore(spark, f"{root}/links")
        self.depths = SnapshotStore(spark, f"{root}/depths")
        # version 0 is the state before the first batch
        self.depths.save(0, seeds.select("entity", "url").distinct().withColumn("depth", F.lit(0)))

    def take(self, links: DataFrame, batch: int) -> None:
        """Takes a batch of links in; batches are numbered from 0."""
        version = batch + 1
        new = self.links.save(version, links.select("src", "dst").distinct())
        earlier = [v for v in self.links.versions() if v <= version]
        known = stored(self._least(self.depths.read(*[v for v in self.depths.versions() if v < version])), "reach-known")
        every = self.links.read(*earlier)
        better = self._improved(known, new, known)
        rounds = [better]
        found = []
        while not better.isEmpty():
            if len(rounds) >= COMPACT_EVERY:      # keeps the plans bounded in size
                found = [stored(self._least(_union(found + rounds)), "reach-found")]
                rounds = []
            better = self._improved(better, every, _union([known, *found, *rounds]))
            rounds.append(better)
        self.depths.save(version, self._least(_union(found + rounds)))

    def reached(self) -> DataFrame:
        """``entity, url, depth`` after the last batch."""
        return self._least(self.depths.read())

    @staticmethod
    def _least(rows: DataFrame) -> DataFrame:
        return rows.groupBy("entity", "url").agg(F.min("depth").alias("depth"))

    def _improved(self, start: DataFrame, links: DataFrame, known: DataFrame) -> DataFrame:
        """URLs that one step from ``start`` reaches on a shorter way than is known (in any
        of several rows).  New and known depths meet in one aggregate and the links by a
        shuffle, so no table passes through the driver."""
        step = (start.hint("shuffle_hash").join(links, F.col("url") == F.col("src"))
                .select("entity", F.col("dst").alias("url"), (F.col("depth") + 1).alias("depth"), F.lit(None).cast("int").alias("before")))
        both = step.unionByName(known.select("entity", "url", F.lit(None).cast("int").alias("depth"), F.col("depth").alias("before")))
        least = both.groupBy("entity", "url").agg(F.min("depth").alias("depth"), F.min("before").alias("before"))
        return stored(least.where(F.col("depth").isNotNull() & (F.col("before").isNull() | (F.col("depth") < F.col("before"))))
                      .drop("before"), "reach-round")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def run_reach(seeds: DataFrame, links_path: str, links_schema: str, max_files: int = 1) -> DataFrame:
    """Streams the links of a folder, ``max_files`` files a batch, to the end."""
    spark = seeds.sparkSession
    root = scratch_dir(spark, "stream-reach")
    state = ReachState(spark, root, seeds)
    q = (spark.readStream.schema(links_schema).option("maxFilesPerTrigger", max_files).parquet(links_path)
         .writeStream.foreachBatch(state.take).option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return state.reached()
