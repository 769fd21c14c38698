"""Secret scans with corpus-wide ownership frequency.

Candidates are regular-expression matches; every kind is matched on its own, from
left to right without overlap.  Each candidate value is then counted over the
whole corpus by distinct owners and repositories: a value that several owners
have is an example that was copied; a varied value of one owner looks live while it
stands in few of that owner's repositories, and is shared when it was copied over many.

The operator is native: the text between the matches (``split``) and the matches
themselves give the positions by running sums.

Defined cases: null text is the empty text; a null owner or repository counts as
one of its own; rows that repeat are reported each and count once; an empty table
gives an empty result.  Other columns are ignored, whatever their names.  A text may
hold any number of matches: their positions take linear time, and the counts are
joined to the spans as rows, so that a value that stands everywhere is many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, materialize, text_or_empty

#: kind -> (pattern, group of the value, least length of the value), in report order
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # runs of one class: the shortest length can stand in the pattern
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
ADDED = {
    "github": (r"gh[pousr]_[A-Za-z0-9]{30,}", 0, 34),
    "slack": (r"xox[abeprs]-[A-Za-z0-9-]{10,}", 0, 15),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29),
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    "url_login": (r"://[A-Za-z0-9._-]+:([^\x20\x09-\x0D/:@]{3,})@", 1, 3),
}
COPIED_OWNERS, COPIED_REPOSITORIES, VARIED_SIGNS, BLOCK = 3, 3, 6, 64


def running_sums(lengths: Column) -> Column:
    """For each element the sum of those before it: sums of blocks, their running sums,
    and inside a block from its beginning, so that n elements take about 32 * n steps.
    ``lengths`` is read in lambdas, so it must be bound and not empty."""
    zero = F.lit(0)
    total = lambda part: F.aggregate(part, zero, lambda a, x: a + x)
    places = F.sequence(zero, F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    block = lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK)

    def inside(begins: Column) -> Column:
        return F.flatten(F.transform(places, lambda b: bound(block(b), lambda part: F.transform(
            F.sequence(zero, F.size(part) - 1), lambda j: F.get(begins, b) + total(F.slice(part, F.lit(1), j))))))
    return bound(F.transform(places, lambda b: total(block(b))), lambda sums: bound(
        F.transform(places, lambda b: total(F.slice(sums, F.lit(1), b))), inside))


def spans_of(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """Array of (start, rank, kind, end, value) of the kind's matches in the text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
    sizes = F.transform(found, lambda m: F.char_length(m))
    kind_type = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"

    def placed(m: Column) -> Column:
        gap = F.slice(m["gaps"], F.lit(1), F.size(m["sizes"]))
        starts = bound(F.zip_with(gap, m["sizes"], lambda g, n: g + n),
                       lambda steps: F.zip_with(running_sums(steps), gap, lambda a, g: a + g))
        rows = F.transform(F.arrays_zip(starts.alias("a"), m["sizes"].alias("n"), m["values"].alias("v")),
                           lambda r: F.struct(r["a"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                                              (r["a"] + r["n"]).alias("end"), r["v"].alias("value")))
        return F.filter(rows, lambda r: F.char_length(r["value"]) >= least).cast(kind_type)
    matches = F.struct(values.alias("values"), gaps.alias("gaps"), sizes.alias("sizes"))
    return F.when(F.regexp_like(text, F.lit(pattern)), bound(matches, placed)).otherwise(F.array().cast(kind_type))


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """``doc_id, row, owner, repository, spans`` of every row, spans by start and kind."""
    text = text_or_empty()
    kinds = BASE | ADDED
    parts = [spans_of(F.col("text"), kind, rank, *kinds[kind]) for rank, kind in enumerate(kinds)]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                       owner.cast("string").alias("owner"), repository.cast("string").alias("repository"))
    parts_of_row = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("doc_id", "owner", "repository")]
    return rows.select("doc_id", F.sha2(F.concat_ws("\x1f", *parts_of_row, "text"), 256).alias("row"), "owner",
                       "repository", F.array_sort(F.concat(*parts)).alias("spans"))


def ownership(rows: DataFrame) -> DataFrame:
    """``value_hash, n_owners, n_repositories`` of every candidate value in the corpus."""
    held = (rows.select("owner", "repository", F.explode("spans").alias("s"))
            .select(F.sha2(F.col("s.value"), 256).alias("value_hash"), "owner", "repository").distinct())
    counted = held.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def verdict(value: Column, n_owners: Column, n_repositories: Column) -> Column:
    varied = F.size(F.array_distinct(F.split(value, ""))) >= VARIED_SIGNS
    example = (n_owners >= COPIED_OWNERS) | ~varied | F.lower(value).contains("example")
    return (F.when(example, "example")
            .when((n_owners == 1) & (n_repositories < COPIED_REPOSITORIES), "live").otherwise("shared"))


def candidates(rows: DataFrame) -> DataFrame:
    """One row per span: ``doc_id, row, kind, start, end, value, n_owners, n_repositories, verdict``."""
    each = (rows.select("doc_id", "row", F.explode("spans").alias("s")).select("doc_id", "row", "s.*")
            .withColumn("value_hash", F.sha2("value", 256)))
    # stored, as a join can split a hot value of a plain table only
    counts = materialize(ownership(rows), "secret-owners")
    return (each.join(counts, "value_hash")
            .withColumn("verdict", verdict(F.col("value"), F.col("n_owners"), F.col("n_repositories")))
            .drop("value_hash", "rank"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is_kind(kind: str):
    return lambda s: F.when(s["kind"] == kind, True)


def secrets(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Per row: ``doc_id, spans``, the number of base spans of each kind and of live, shared
    and example values, and the most owners and repositories that one of its values has."""
    rows = materialize(scan(docs, owner, repository), "secret-spans")
    place = F.struct("kind", "start")
    counts = candidates(rows).groupBy("row").agg(*[
        F.count_distinct(F.when(F.col("verdict") == v, place)).alias(f"n_{v}") for v in ("live", "shared", "example")],
        F.max("n_owners").alias("most_owners"), F.max("n_repositories").alias("most_repositories"))
    per_kind = [F.array_size(F.array_compact(F.transform("spans", _is_kind(k)))).cast("bigint").alias(f"n_{k}")
                for k in BASE]
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return rows.join(counts, "row", "left").select(
        "doc_id", "spans", base.alias("base_spans"), *per_kind,
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n)
          for n in ("n_live", "n_shared", "n_example", "most_owners", "most_repositories")])
