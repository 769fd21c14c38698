"""Frontier expansion (best-first crawl) as level-synchronous DataFrame rounds.

Round r takes the URLs first reached in round r-1, joins them to their
outgoing links, drops what any earlier round already visited (left anti
join on (entity, url)) and records the rest with depth r.  Run to
exhaustion this visits exactly the URLs reachable over emitted links, with
their shortest depth, whatever order a sequential crawler pops them in.

Per-site early stop: a site whose visited pages already cover every
required section is not expanded further (checked once per round).

With a ``SnapshotStore`` every round is published as a version of the crawl's result
(``history`` gives the counts after each).  A crawl that ended between rounds, or in
one, goes on from the last published round when it is called again.

Each round's new rows are written to a folder of their own below the session's
checkpoint folder, so a lost executor only recomputes one round, and the plan does not
grow with the round count.  What is visited is read as files, in as many tasks as its
size asks for and not as rounds times partitions.  The links are written once; a small
frontier goes to them, and only pages with huge link lists are known by name.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.session import cut_lineage, ensure_checkpoint_dir, stored
from sitelens.sources.snapshots import SnapshotStore


#: Links of one page that one cell holds; pages with more are spread over several.
LINKS_PER_CELL = 10_000


def _hubs(links: DataFrame) -> DataFrame:
    """The pages whose links take several cells, and how many."""
    return (links.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / LINKS_PER_CELL).alias("parts"))
            .where(F.col("parts") > 1))


def _cells(edges: DataFrame) -> DataFrame:
    """Links keyed by (src, salt): a page with a huge link list is spread over
    as many cells as its measured number of links asks for."""
    links = edges.select("src", "dst", "priority").distinct()
    hubs = _hubs(links)
    salt = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.hash("dst"), F.col("parts")))
    return links.join(hubs, "src", "left").select("src", salt.cast("int").alias("salt"), "dst", "priority")


def crawl(seeds: DataFrame, edges: DataFrame, page_sections: DataFrame | None = None,
          required: list[str] | None = None, compact_every: int = 16,
          snapshots: SnapshotStore | None = None, stop_after: int | None = None) -> DataFrame:
    """seeds(entity, url), edges(src, dst[, priority]) -> visited(entity, url, depth, priority).

    ``snapshots`` publishes each round and resumes from the last one published;
    ``stop_after`` ends the call after that round, with the crawl open.

    Rounds go on until one reaches no new URL, whatever the depth of the graph.
    ``page_sections(url, section)`` with ``required`` enables the per-site
    coverage stop.  ``depth`` is the round in which the URL was first popped."""
    ensure_checkpoint_dir(seeds.sparkSession)
    if "priority" not in edges.columns:
        edges = edges.withColumn("priority", F.lit("high"))
    # partition numbers are left to the session and to adaptive execution
    links = stored(_cells(edges), "crawl-links")
    hubs = stored(_hubs(links), "crawl-hubs")

    coverage = page_sections is not None and bool(required)
    if coverage:
        page_sections = cut_lineage(page_sections.select("url", "section").distinct())
    def keep(rows: DataFrame, version: int) -> DataFrame:
        return snapshots.save(version, rows) if snapshots else stored(rows, "crawl-round")

    done = snapshots.versions() if snapshots else []
    if done:
        r, visited = done[-1], snapshots.read(*done)
        frontier = snapshots.read(r)
    else:
        r = 0
        visited = frontier = keep(seeds.select("entity", "url").distinct()
                                  .withColumn("depth", F.lit(0)).withColumn("priority", F.lit("high")), 0)
    pieces = [visited]
    need = F.array(*[F.lit(s) for s in (required or [])])
    # sections found per site, grown from each round's new pages only (at most
    # sites x sections rows) instead of re-joining every visited page per round
    found = visited.join(page_sections, "url").select("entity", "section").distinct() if coverage else None
    held: list[DataFrame] = []
    while stop_after is None or r < stop_after:
        r += 1
        active = frontier
        if coverage:
            per_site = found.groupBy("entity").agg(F.collect_set("section").alias("found"))
            done_sites = per_site.where(F.size(F.array_except(need, F.col("found"))) == 0).select("entity")
            active = frontier.join(done_sites, "entity", "left_anti")
        salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)).cast("int")))
        step = (active.select("entity", F.col("url").alias("src"))
                .join(hubs, "src", "left").select("entity", "src", salts.alias("salt"))
                .join(links, ["src", "salt"])
                .groupBy("entity", F.col("dst").alias("url"))
                .agg(F.min(F.when(F.col("priority") == "high", 0)
                           .when(F.col("priority") == "medium", 1).otherwise(2)).alias("p")))
        fresh = keep(step.join(_union(pieces), ["entity", "url"], "left_anti")
                     .select("entity", "url", F.lit(r).alias("depth"),
                             F.element_at(F.array(F.lit("high"), F.lit("medium"), F.lit("low")),
                                          F.col("p") + 1).alias("priority")), r)
        if fresh.isEmpty():
            break
        pieces.append(fresh)
        frontier = fresh
        if coverage:
            found = (found.unionByName(fresh.join(page_sections, "url").select("entity", "section"))
                     .distinct().persist(StorageLevel.MEMORY_AND_DISK))
            held.append(found)
            for old_state in held[:-2]:     # earlier states are no longer read
                old_state.unpersist()
            held = held[-2:]
        if len(pieces) > compact_every:
            # keep the visited union (and every later plan) bounded in size
            pieces = [stored(_union(pieces), "crawl-visited")]
            if coverage:
                found = cut_lineage(found)
    return _union(pieces)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crawl_stats(visited: DataFrame, page_sections: DataFrame) -> DataFrame:
    """Per site: pages visited, relevant pages (at least one section), rounds."""
    rel = page_sections.select(F.col("url").alias("_u")).distinct().withColumn("_rel", F.lit(1))
    v = visited.join(rel, visited.url == rel._u, "left")
    return v.groupBy("entity").agg(
        F.count("*").alias("total_pages_visited"),
        F.count("_rel").alias("relevant_pages_found"),
        F.max("depth").alias("rounds"))



def history(snapshots: SnapshotStore, page_sections: DataFrame) -> DataFrame:
    """Per site and round the crawl's counts as they were after that round: ``entity,
    round, total_pages_visited, relevant_pages_found``."""
    rel = page_sections.select("url").distinct().withColumn("rel", F.lit(1))
    each = (snapshots.read().join(rel, "url", "left").groupBy("entity", F.col("depth").alias("round"))
            .agg(F.count(F.lit(1)).alias("n"), F.count("rel").alias("n_rel")))
    so_far = Window.partitionBy("entity").orderBy("round")       # a row a round
    return each.select("entity", "round", F.sum("n").over(so_far).alias("total_pages_visited"),
                       F.sum("n_rel").over(so_far).alias("relevant_pages_found"))
