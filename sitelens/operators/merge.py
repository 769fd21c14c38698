"""Order-sensitive deep merge of JSON fragments into one record per site.

The fold being reproduced (per key, fragments in order):
  absent -> assign as is; object+object -> recurse; list+list -> append
  unseen items (repeats inside the new list dropped too); otherwise replace
  only a falsy value with a truthy one.
It is not associative, so it cannot be a free-order partial aggregate.  Its
exact relational form (used here) needs only per-path aggregates:

* winner of a path = its first truthy occurrence; with none, its first
  present one.  Its kind is the merged node's kind.
* a path survives iff every proper ancestor's winner is an object.
* scalar value = winner's value.
* array items = the winner array (verbatim when it was assigned into an
  absent or non-list slot, de-duplicated when it extended an earlier ``[]``)
  followed by the items of later arrays whose canonical form was not seen
  before, ordered by (fragment seq, item index).

Every step is a grouped aggregate with map-side combine (``min`` over a
struct), a join on (entity, path) or a narrow projection, so a site holding
a third of the data is spread over many tasks; no group is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.jsonpaths import json_nodes
from sitelens.session import cut_lineage


def fragment_nodes(fragments: DataFrame, schema_keys: list[str] | None = None) -> DataFrame:
    """fragments(entity, seq, json) -> entity, seq, path array<string>, depth,
    kind, value, truthy, items, error, position.

    Fragments that are no JSON object give one row of depth 0 with the error.
    Top-level schema keys absent from a fragment are filled with ``{}``; a
    fragment still empty after that is dropped."""
    return json_nodes(fragments, "json", ["entity", "seq"], list(schema_keys or []))


def fragment_errors(nodes: DataFrame) -> DataFrame:
    """The fragments that were skipped: reason, position and the text around it."""
    return nodes.where("depth = 0").select("entity", "seq", F.col("error").alias("reason"), "position",
                                           F.col("value").alias("context"))


def merge_nodes(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes -> (merged nodes, merged array items).

    merged nodes: entity, path, depth, kind, value, source_seq (the fragment it comes from).
    merged items: entity, path, seq, idx, kind, value (order = (seq, idx))."""
    nodes = nodes.where("depth > 0")
    occ = F.struct("seq", "kind", "value")
    w = nodes.groupBy("entity", "path").agg(
        F.min(F.when(F.col("truthy"), occ)).alias("t"), F.min(occ).alias("f"), F.first("depth").alias("depth"))
    # read several times below: a row per path, written once
    w = cut_lineage(w.select("entity", "path", "depth", "t", "f",
                             F.coalesce(F.col("t.kind"), F.col("f.kind")).alias("kind"),
                             F.when(F.col("t").isNotNull(), F.col("t.value")).otherwise(F.col("f.value")).alias("value")))

    # a path lives iff all proper ancestors won as objects
    anc = (w.where(F.col("depth") > 1)
           .select("entity", "path", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)).alias("i"))
           .select("entity", "path", F.slice("path", 1, F.col("i")).alias("anc")))
    wk = w.select("entity", F.col("path").alias("anc"), F.col("kind").alias("anc_kind"))
    dead = (anc.join(wk, ["entity", "anc"]).where(F.col("anc_kind") != "object")
            .select("entity", "path").distinct())
    live = w.join(dead, ["entity", "path"], "left_anti")
    merged = live.select("entity", "path", "depth", "kind", "value",
                         F.coalesce(F.col("t.seq"), F.col("f.seq")).alias("source_seq"))

    # arrays with a truthy winner: winner items, then unseen later items
    arr = (live.where((F.col("kind") == "array") & F.col("t").isNotNull())
           .select("entity", "path", F.col("t.seq").alias("t_seq"),
                   ((F.col("f.seq") == F.col("t.seq")) | (F.col("f.kind") != "array")).alias("verbatim")))
    item_rows = (nodes.where(F.col("kind") == "array")
                 .join(arr, ["entity", "path"])
                 .where(F.col("seq") >= F.col("t_seq"))
                 .select("entity", "path", "seq", "t_seq", "verbatim",
                         F.posexplode("items").alias("idx", "it"))
                 # dealt out anew by item: the join's own exchange then serves nothing above
                 # it, and its skewed partitions can be split
                 .repartition("entity", "path", F.col("it.canon")))
    firsts = (item_rows.groupBy("entity", "path", F.col("it.canon").alias("canon"))
              .agg(F.min(F.struct("seq", "idx", F.col("it.kind").alias("kind"),
                                  F.col("it.value").alias("value"))).alias("m"))
              .select("entity", "path", "m.seq", "m.idx", "m.kind", "m.value"))
    repeats = (item_rows.where(F.col("verbatim") & (F.col("seq") == F.col("t_seq")))
               .select("entity", "path", "seq", "idx", F.col("it.kind").alias("kind"), F.col("it.value").alias("value"))
               .join(firsts.select("entity", "path", "seq", "idx"), ["entity", "path", "seq", "idx"], "left_anti"))
    items = firsts.unionByName(repeats)
    return merged, items


def summarise(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a record keeps of some fragments so that others can still be merged in:
    ``(paths, items)``.

    paths: entity, path, depth and the first truthy (t) and first present (f) occurrence.
    items: entity, path, canon, seq, idx, kind, value of each array item's first place,
    and the other places of items in the array that t is (``repeat``).

    Summaries of any parts of the fragments, in any order, join to the summary of the
    whole (``join_summaries``).  Minima do so.  Items stand in arrays that are truthy,
    so none comes before t, and whichever array becomes the winner later has all its
    own places here, as it is the first truthy occurrence of its part as well."""
    nodes = nodes.where("depth > 0")
    occ = F.struct("seq", "kind", "value")
    paths = nodes.groupBy("entity", "path").agg(
        F.first("depth").alias("depth"), F.min(F.when(F.col("truthy"), occ)).alias("t"), F.min(occ).alias("f"))
    rows = (nodes.where(F.col("kind") == "array").select("entity", "path", "seq", F.posexplode("items").alias("idx", "it"))
            .select("entity", "path", F.col("it.canon").alias("canon"), F.col("seq"), "idx",
                    F.col("it.kind").alias("kind"), F.col("it.value").alias("value")))
    return _kept(paths, rows)


def _kept(paths: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    place = F.struct("seq", "idx", "kind", "value")
    firsts = (rows.groupBy("entity", "path", "canon").agg(F.min(place).alias("m"))
              .select("entity", "path", "canon", "m.*"))
    winners = paths.where(F.col("t.kind") == "array").select("entity", "path", F.col("t.seq").alias("seq"))
    repeats = (rows.join(winners, ["entity", "path", "seq"])
               .join(firsts.select("entity", "path", "seq", "idx"), ["entity", "path", "seq", "idx"], "left_anti"))
    columns = ["entity", "path", "canon", "seq", "idx", "kind", "value"]
    items = (firsts.select(*columns).withColumn("repeat", F.lit(False))
             .unionByName(repeats.select(*columns).withColumn("repeat", F.lit(True))))
    return paths, items


def join_summaries(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The summary of both parts; associative and commutative, for parts without a
    fragment (entity, seq) in common, and idempotent for equal ones."""
    paths = (a[0].unionByName(b[0]).groupBy("entity", "path")
             .agg(F.first("depth").alias("depth"), F.min("t").alias("t"), F.min("f").alias("f")))
    rows = a[1].unionByName(b[1]).drop("repeat").distinct()
    return _kept(paths, rows)


def finish(summary: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(merged nodes, merged array items) of a summary, as ``merge_nodes`` gives them."""
    paths, items = summary
    w = cut_lineage(paths.select("entity", "path", "depth", "t", "f",
                                 F.coalesce(F.col("t.kind"), F.col("f.kind")).alias("kind"),
                                 F.when(F.col("t").isNotNull(), F.col("t.value")).otherwise(F.col("f.value")).alias("value")))
    above = (w.where(F.col("depth") > 1)
             .select("entity", "path", F.explode(F.transform(F.sequence(F.lit(1), F.col("depth") - 1),
                                                             lambda i: F.slice("path", 1, i))).alias("up")))
    no_object = w.where(F.col("kind") != "object").select("entity", F.col("path").alias("up"))
    dead = above.join(no_object, ["entity", "up"]).select("entity", "path").distinct()
    live = w.join(dead, ["entity", "path"], "left_anti")
    arrays = (live.where((F.col("kind") == "array") & F.col("t").isNotNull())
              .select("entity", "path", ((F.col("f.seq") == F.col("t.seq")) | (F.col("f.kind") != "array")).alias("verbatim")))
    kept = items.join(arrays, ["entity", "path"]).where(~F.col("repeat") | F.col("verbatim"))
    return (live.select("entity", "path", "depth", "kind", "value",
                        F.coalesce(F.col("t.seq"), F.col("f.seq")).alias("source_seq")),
            kept.select("entity", "path", "seq", "idx", "kind", "value"))


class RecordStore:
    """Summaries in the shared folder, a version an upsert; new fragments are merged into
    the last version without reading the earlier fragments again."""

    def __init__(self, spark, root: str):
        from sitelens.sources.snapshots import SnapshotStore
        self.paths, self.items = SnapshotStore(spark, f"{root}/paths"), SnapshotStore(spark, f"{root}/items")

    def upsert(self, fragments: DataFrame, version: int, schema_keys: list[str] | None = None) -> None:
        """Merges the fragments in as ``version`` (numbers ascend; one that is repeated
        after a failure is kept once)."""
        new = summarise(cut_lineage(fragment_nodes(fragments, schema_keys)))
        earlier = [v for v in self.items.versions() if v < version]
        if earlier:
            new = join_summaries(self.summary(earlier[-1]), new)
        self.paths.save(version, new[0])
        self.items.save(version, new[1])        # published last: a version counts once its items are there

    def summary(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        version = self.items.versions()[-1] if version is None else version
        return self.paths.read(version), self.items.read(version)


def merge_fragments(fragments: DataFrame, schema_keys: list[str] | None = None, materialize: bool = True):
    """Flatten once (materialised with a reliable checkpoint, since the node
    table feeds three branches of the merge), then merge."""
    nodes = fragment_nodes(fragments, schema_keys)
    if materialize:
        nodes = cut_lineage(nodes)
    merged, items = merge_nodes(nodes)
    return merged, items, fragment_errors(nodes)


def flat_record(merged: DataFrame, items: DataFrame) -> DataFrame:
    """One table for nodes and items: entity, path ('.'-joined), node_type,
    kind, value, item_seq, item_idx."""
    n = merged.select("entity", F.array_join("path", ".").alias("path"), F.lit("node").alias("node_type"),
                      "kind", "value", F.lit(None).cast("bigint").alias("item_seq"),
                      F.lit(None).cast("int").alias("item_idx"))
    i = items.select("entity", F.array_join("path", ".").alias("path"), F.lit("item").alias("node_type"),
                     "kind", "value", F.col("seq").cast("bigint").alias("item_seq"),
                     F.col("idx").cast("int").alias("item_idx"))
    return n.unionByName(i)


def _decode(kind: str, value):
    import json
    if kind == "string":
        return value
    if kind == "object":
        return {}
    if kind == "array":
        return []
    if value is None:
        return None
    return json.loads(value)


def _decode_item(kind: str, value):
    import json
    if kind == "string":
        return value
    return None if value is None else json.loads(value)


def assemble(nodes: list[tuple], items: list[tuple]) -> dict:
    """Nested record from merged nodes (path, kind, value) and items
    (path, seq, idx, kind, value) of one site."""
    out: dict = {}
    for path, kind, value in sorted(nodes, key=lambda r: len(r[0])):
        cur = out
        for k in path[:-1]:
            cur = cur[k]
        cur[path[-1]] = _decode(kind, value)
    for path, _seq, _idx, kind, value in sorted(items, key=lambda r: (r[1], r[2])):
        cur = out
        for k in path[:-1]:
            cur = cur[k]
        cur[path[-1]].append(_decode_item(kind, value))
    return out


def records_json(merged: DataFrame, items: DataFrame) -> DataFrame:
    """One JSON record per site, wrapped as institutions/programs (the record
    sink's shape).  Assembly needs the whole record, which is the output unit;
    everything before it is distributed."""
    import json
    import pandas as pd

    tagged = merged.select("entity", "path", F.lit(None).cast("bigint").alias("seq"),
                           F.lit(None).cast("int").alias("idx"), "kind", "value", F.lit(0).alias("is_item")).unionByName(
        items.select("entity", "path", F.col("seq").cast("bigint"), F.col("idx").cast("int"), "kind", "value",
                     F.lit(1).alias("is_item")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = [(list(r.path), r.kind, r.value) for r in pdf[pdf.is_item == 0].itertuples()]
        its = [(list(r.path), r.seq, r.idx, r.kind, r.value) for r in pdf[pdf.is_item == 1].itertuples()]
        rec = assemble(nodes, its)
        entity = pdf.entity.iloc[0]
        doc = {"institutions": [{"institution_name": entity, "programs": [rec]}]}
        return pd.DataFrame({"entity": [entity], "json": [json.dumps(doc, ensure_ascii=False)]})

    return tagged.groupBy("entity").applyInPandas(build, "entity string, json string")
