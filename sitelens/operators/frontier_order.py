"""The crawl in its exact order: one queue a site, stopped at the page that completes it.

The queue gives the URL of the best priority class, of equal ones the one that came
first; a URL that was popped before is skipped; a popped page's links are added behind.
Nothing in this asks for one page at a time:

* as long as no better class turns up, the entries of the best class are popped in the
  order in which they came, ``(pop number of the page, place of the link on it)``.  So a
  round pops all of them at once and numbers them by a distributed prefix count
  (``ordinals``);
* the round ends at the first page that links to a better class, as that link is next;
* coverage is a minimum a section: the pop number that found it first.  The site
  ends at the greatest of these, once every required section has one, in the middle of a
  round if need be, and the links of that page are not added.

Rounds are as many as levels of the graph where one class is used, and at most one more
for each time that a better class turns up.  Sites run side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.operators.ordinals import ordinal_within
from sitelens.session import cut_lineage

COMPACT_EVERY = 16


def _class(priority):
    return F.when(priority == "high", 0).when(priority == "medium", 1).otherwise(2)


def crawl_in_order(seeds: DataFrame, links: DataFrame, page_sections: DataFrame | None = None,
                   required: list[str] | None = None) -> DataFrame:
    """seeds(entity, url), links(src, dst, link_seq, priority), page_sections(url, section)
    -> ``entity, url, pos, priority``: what is popped, numbered from 0, until the queue is
    empty or the required sections are found."""
    spark = seeds.sparkSession
    required = sorted(set(required or []))
    links = cut_lineage(links.select("src", "dst", "link_seq", _class(F.col("priority")).alias("cls"))
                        .repartition("src"))
    # the best class that a page links to
    offers = cut_lineage(links.groupBy(F.col("src").alias("url")).agg(F.min("cls").alias("offer")))
    wanted = None
    if page_sections is not None and required:
        wanted = cut_lineage(page_sections.where(F.col("section").isin(required)).select("url", "section").distinct())
    place = "struct<pos:bigint,link_seq:bigint>"
    queue = [cut_lineage(seeds.select("entity", "url", F.lit(0).alias("cls"),
                                      F.struct(F.lit(-1), F.lit(0)).cast(place).alias("came")).distinct())]
    popped: list[DataFrame] = []
    found = spark.createDataFrame([], "entity string, section string, pos bigint")
    sites = cut_lineage(seeds.select("entity", F.lit(0).cast("bigint").alias("base")).distinct())
    while True:
        waiting = _union(queue).join(sites.select("entity"), "entity", "left_semi")
        if popped:
            waiting = waiting.join(_union(popped).select("entity", "url"), ["entity", "url"], "left_anti")
        # of several entries of a URL the first to come up counts
        waiting = cut_lineage(waiting.groupBy("entity", "url").agg(F.min(F.struct("cls", "came")).alias("e"))
                              .select("entity", "url", "e.cls", "e.came"))
        if waiting.isEmpty():
            break
        best = waiting.groupBy("entity").agg(F.min("cls").alias("cls"))
        block = ordinal_within(waiting.join(best, ["entity", "cls"]), ["entity"], ["came"], "at").join(sites, "entity")
        block = cut_lineage(block.select("entity", "url", "cls", (F.col("base") + F.col("at")).alias("pos")))
        end = (block.join(offers, "url").where(F.col("offer") < F.col("cls"))
               .groupBy("entity").agg(F.min("pos").alias("end")))
        state = sites.join(end, "entity", "left")
        if wanted is not None:
            here = block.join(wanted, "url").select("entity", "section", "pos")
            found = cut_lineage(found.unionByName(here).groupBy("entity", "section").agg(F.min("pos").alias("pos")))
            complete = (found.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("complete"))
                        .where(F.col("n") == len(required)).drop("n"))
            state = state.join(complete, "entity", "left")
        else:
            state = state.withColumn("complete", F.lit(None).cast("bigint"))
        cut = F.least("end", "complete")
        over = F.col("pos").eqNullSafe(F.col("complete")).alias("completes")
        taken = cut_lineage(block.join(state, "entity").where(cut.isNull() | (F.col("pos") <= cut))
                            .select("entity", "url", "cls", "pos", over))
        if wanted is not None:
            # a section found behind the end of the round is found when its page is popped
            found = cut_lineage(found.join(taken.groupBy("entity").agg(F.max("pos").alias("to")), "entity", "left")
                                .where(F.col("to").isNull() | (F.col("pos") <= F.col("to"))).drop("to"))
        popped.append(taken)
        came = F.struct("pos", F.col("link_seq").cast("bigint").alias("link_seq"))
        more = (taken.where(~F.col("completes")).drop("cls").join(links, F.col("url") == F.col("src"))
                .select("entity", F.col("dst").alias("url"), "cls", came.alias("came")))
        queue = [waiting, cut_lineage(more)]
        counts = taken.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.max("completes").alias("over"))
        sites = cut_lineage(sites.join(counts, "entity", "left")
                            .where(~F.coalesce("over", F.lit(False)))
                            .select("entity", (F.col("base") + F.coalesce("n", F.lit(0))).alias("base")))
        if len(popped) > COMPACT_EVERY:
            popped = [cut_lineage(_union(popped))]
    name = F.element_at(F.array(F.lit("high"), F.lit("medium"), F.lit("low")), F.col("cls") + 1)
    return _union(popped).select("entity", "url", "pos", name.alias("priority")) if popped else (
        seeds.select("entity", "url", F.lit(0).cast("bigint").alias("pos"), F.lit("high").alias("priority")).limit(0))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
