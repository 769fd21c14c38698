"""Published versions, resumed crawls, replayed batches and the streaming frontier."""

import datetime as dt
import random

import pytest
from sitelens.operators import frontier as FR
from sitelens.session import scratch_dir
from sitelens.sources.snapshots import SnapshotStore
from sitelens.streaming import frontier_stream as FS
from sitelens.streaming import streams as ST


def graph(seed, n=40, m=70):
    rnd = random.Random(seed)
    return sorted({(f"n{rnd.randrange(n)}", f"n{rnd.randrange(n)}") for _ in range(m)})


def depths(edges, seed="n0"):
    found, rim = {seed: 0}, [seed]
    while rim:
        rim = sorted({d for s, d in edges if s in set(rim)} - set(found))
        found |= {u: max(found.values()) + 1 for u in rim}
    return found


def test_a_version_is_published_once(spark):
    path = scratch_dir(spark, "versions")
    store = SnapshotStore(spark, path)
    assert store.versions() == []
    assert sorted(r.id for r in store.save(3, spark.range(2), note="a").collect()) == [0, 1]
    assert sorted(r.id for r in store.save(3, spark.range(5)).collect()) == [0, 1]
    again = SnapshotStore(spark, path)
    again.save(7, spark.range(9, 10))
    spark.range(50).write.parquet(f"{path}/data/0000000008-lost")      # written, never published
    assert again.versions() == [3, 7] and again.facts(3) == {"note": "a"}
    assert sorted(r.id for r in again.read().collect()) == [0, 1, 9]
    assert not again._publish(7, {"folder": "other"})
    assert [r.id for r in again.read(7).collect()] == [9]


def test_a_crawl_that_fails_in_a_round_goes_on_from_the_last_published(spark):
    links = graph(3, 14, 24)
    edges = spark.createDataFrame(links, "src string, dst string")
    seeds = spark.createDataFrame([("s", "n0")], "entity string, url string")
    path = scratch_dir(spark, "resumed")

    class Failing(SnapshotStore):
        def _publish(self, version, manifest):
            if version == 2:
                raise RuntimeError("lost")
            return super()._publish(version, manifest)

    with pytest.raises(RuntimeError):
        FR.crawl(seeds, edges, snapshots=Failing(spark, path))
    store = SnapshotStore(spark, path)
    assert store.versions() == [0, 1]
    got = {r.url: r.depth for r in FR.crawl(seeds, edges, snapshots=store).collect()}
    assert got == depths(links)
    # a finished crawl is taken up without work
    assert {r.url: r.depth for r in FR.crawl(seeds, edges, snapshots=store).collect()} == got
    sections = spark.createDataFrame([("n0", "A"), ("n3", "A")], "url string, section string")
    counts = {r.round: (r.total_pages_visited, r.relevant_pages_found) for r in FR.history(store, sections).collect()}
    for k in range(max(got.values()) + 1):
        near = [u for u, d in got.items() if d <= k]
        assert counts[k] == (len(near), len({"n0", "n3"} & set(near)))


def test_a_resumed_crawl_keeps_its_coverage_stop(spark):
    edges = spark.createDataFrame([(f"p{i}", f"p{i + 1}") for i in range(6)], "src string, dst string")
    seeds = spark.createDataFrame([("s", "p0")], "entity string, url string")
    ps = spark.createDataFrame([("p0", "A"), ("p3", "B")], "url string, section string")
    store = SnapshotStore(spark, scratch_dir(spark, "covered"))
    FR.crawl(seeds, edges, ps, ["A", "B"], snapshots=store, stop_after=1)
    assert store.versions() == [0, 1]
    got = FR.crawl(seeds, edges, ps, ["A", "B"], snapshots=store)
    assert sorted(r.url for r in got.collect()) == ["p0", "p1", "p2", "p3"]


def test_links_in_any_order_end_at_the_depths_of_one_crawl(spark):
    links = graph(1, 14, 24) + [("n1", "z1"), ("z1", "z2")]
    random.Random(1).shuffle(links)
    seeds = spark.createDataFrame([("s", "n0"), ("t", "n5")], "entity string, url string")
    state = FS.ReachState(spark, scratch_dir(spark, "reach"), seeds)
    for k in range(3):
        batch = spark.createDataFrame(links[k::3], "src string, dst string")
        state.take(batch, k)
        if k == 1:
            state.take(batch, k)                       # replayed
        seen = [x for j in range(k + 1) for x in links[j::3]]
        got = {(r.entity, r.url): r.depth for r in state.reached().collect()}
        assert got == {("s", u): d for u, d in depths(seen).items()} | {("t", u): d for u, d in depths(seen, "n5").items()}


def test_a_batch_that_fails_and_is_replayed_is_stored_once(spark):
    path, out = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    spark.range(6).repartition(3).write.parquet(path)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(path)

    class Failing(SnapshotStore):
        def save(self, version, df, **facts):
            super().save(version, df, **facts)
            if version == 1:
                raise RuntimeError("lost after it was published")

    with pytest.raises(Exception, match="lost after"):
        ST.publish_batches(stream, lambda b: b, Failing(spark, out), out + "-ckpt")
    store = SnapshotStore(spark, out)
    ST.publish_batches(stream, lambda b: b, store, out + "-ckpt")
    assert sorted(r.id for r in store.read().collect()) == list(range(6))


def test_a_call_exactly_one_gap_later_belongs_to_the_session(spark):
    at = lambda us: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=us)
    rows = [("a", at(0), 1, 1), ("a", at(60_000_000), 1, 1), ("a", at(120_000_001), 1, 1), ("b", at(5), 1, 1)]
    random.Random(1).shuffle(rows)
    calls = spark.createDataFrame(rows, "caller string, ts timestamp, prompt_tokens bigint, completion_tokens bigint")
    expected = {("a", at(0), at(120_000_000), 2), ("a", at(120_000_001), at(180_000_001), 1), ("b", at(5), at(60_000_005), 1)}
    seen = lambda frame: {(r.caller, r.session_start, r.session_end, r.n_calls) for r in frame.collect()}
    assert seen(ST._sessions(calls, "60 seconds")) == expected
    # in a stream, a file a batch, then a late call of another caller that moves the watermark on
    path, out = scratch_dir(spark, "calls"), scratch_dir(spark, "sessions")
    for k, row in enumerate([*rows, ("z", at(900_000_000), 1, 1)]):
        spark.createDataFrame([row], calls.schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(path)
    ST._run(ST.usage_session_stream(stream, "60 seconds", "10 minutes"), out)
    assert seen(spark.read.parquet(out)) == expected
    closed = spark.createDataFrame([("a", at(0), at(120_000_000), 2, 4)],
                                   "caller string, session_start timestamp, session_end timestamp, n_calls bigint, tokens bigint")
    left = {(r.caller, r.session_start) for r in ST.open_sessions(calls, closed, "60 seconds").collect()}
    assert left == {("a", at(120_000_001)), ("b", at(5))}
