"""What a round of the crawl and of the streamed reach costs besides its rows."""

from sitelens.operators import frontier as FR
from sitelens.session import scratch_dir
from sitelens.streaming import frontier_stream as FS


def test_visited_takes_few_tasks_however_many_rounds(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(0, 100 + i) for i in range(300)], "src long, dst long")
        visited = FR.crawl(spark.createDataFrame([("s", 0)], "entity string, url long"), edges)
        assert {(r.url, r.depth) for r in visited.collect()} == (
            {(i, i) for i in range(7)} | {(100 + i, 1) for i in range(300)})
        assert visited.rdd.getNumPartitions() < 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hub_pages_are_followed_over_all_their_cells(spark, monkeypatch):
    monkeypatch.setattr(FR, "LINKS_PER_CELL", 10)
    edges = spark.createDataFrame([(0, i) for i in range(1, 95)] + [(94, 200)], "src long, dst long")
    visited = FR.crawl(spark.createDataFrame([("s", 0)], "entity string, url long"), edges)
    assert {(r.url, r.depth) for r in visited.collect()} == {(0, 0)} | {(i, 1) for i in range(1, 95)} | {(200, 2)}


def test_no_table_passes_through_the_driver(spark, monkeypatch):
    plans, keep = [], FS.stored

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, name)
    monkeypatch.setattr(FS, "stored", watched)
    monkeypatch.setattr(FS, "COMPACT_EVERY", 2)
    state = FS.ReachState(spark, scratch_dir(spark, "reach"), spark.createDataFrame([("s", 0)], "entity string, url long"))
    schema = "src long, dst long"
    state.take(spark.createDataFrame([(i, i + 1) for i in range(1, 6)], schema), 0)       # not reached yet
    state.take(spark.createDataFrame([(0, 1)], schema), 1)
    state.take(spark.createDataFrame([(0, 4)], schema), 2)                                # a short cut
    assert {(r.url, r.depth) for r in state.reached().collect()} == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 1), (5, 2), (6, 3)}
    rounds = [p for name, p in plans if name == "reach-round"]
    assert len(rounds) > 6 and not any("Broadcast" in p for p in rounds)
