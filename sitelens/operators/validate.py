"""Validation of record fields against page text and of record shape
against the schema.

Field checks pair every leaf of a site's record with every accessible page
of that site.  The pair count is inherent, so the job spreads it: a site's pages
are dealt over cells of about ``PAGES_PER_CELL`` pages, leaves are replicated only
to the (entity, salt) cells that hold pages, and the pair join runs on
(entity, salt).  A site's number of cells grows with its pages.
Page text is normalised once per page, before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.functions.text import squash_ws

EXACT = "Exact match found"
NO_MATCH = "No match found"
SKIPPED = "Non-string or 'Not published' value"


def normalise(c: Column) -> Column:
    """``' '.join(s.lower().split())``"""
    return squash_ws(F.lower(c))


#: Pages of one site that one cell holds.
PAGES_PER_CELL = 500


def pair_leaves_with_pages(leaves: DataFrame, pages: DataFrame, pages_per_cell: int = PAGES_PER_CELL) -> DataFrame:
    """leaves(entity, field_path, kind, value, ...) x pages(entity, url, page_seq, text)
    within each entity, a site's pages spread over as many cells as their measured
    number asks for."""
    sizes = pages.groupBy("entity").agg(F.ceil(F.count(F.lit(1)) / pages_per_cell).alias("_parts"))
    salted = (pages.join(sizes, "entity").withColumn("_salt", F.pmod(F.hash("url"), F.col("_parts")))
              .drop("_parts"))
    cells = salted.select("entity", "_salt").distinct()
    lv = leaves.join(cells, "entity")
    return lv.join(salted, ["entity", "_salt"]).drop("_salt")


def prepare_leaves(leaves: DataFrame) -> DataFrame:
    """Per-leaf work done once, before pairing: skip flag, normalised value,
    its words and word count."""
    v = F.col("value")
    cv = normalise(v)
    return leaves.select(
        "*", ((F.col("kind") != "string") | (v == vocab.NOT_PUBLISHED) | v.isNull()).alias("skip"),
        cv.alias("cv")).select(
        "*", F.split(F.col("cv"), " ").alias("words"),
        F.when(F.col("cv") == "", F.lit(0)).otherwise(F.size(F.split(F.col("cv"), " "))).alias("n_words"))


def check_fields(pairs: DataFrame, run_ts: str | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """Per (leaf, page): is_valid, source_text, notes (first rule wins), and the columns ``more``.
    ``exact`` and ``matched`` are computed once per pair; the word scan runs
    only for pairs that are neither skipped nor exact."""
    cc = F.col("content_norm")
    step = pairs.select(
        "entity", "field_path", "ord", "url", "page_seq", *more, "skip", "cv", "n_words",
        (~F.col("skip") & cc.contains(F.col("cv"))).alias("exact"), "words", "content_norm")
    step = step.select(
        "entity", "field_path", "ord", "url", "page_seq", *more, "skip", "cv", "n_words", "exact",
        # a one-word value that is not an exact match has no matching word
        F.when(F.col("skip") | F.col("exact"), F.lit(None))
        .when(F.col("n_words") <= 1, F.lit(0))
        .otherwise(F.size(F.filter("words", lambda w: cc.contains(w)))).alias("matched"))
    out = judged(step, more)
    if run_ts:
        out = out.withColumn("validation_date", F.to_timestamp(F.lit(run_ts)))
    return out


def judged(step: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """``check_fields``'s columns from skip, cv, n_words, exact and matched of each pair."""
    fuzzy_ok = F.col("matched") >= F.col("n_words") * F.lit(vocab.FUZZY_SHARE)
    is_valid = F.when(F.col("skip") | F.col("exact"), True).otherwise(fuzzy_ok)
    source = F.when(F.col("skip"), "").when(F.col("exact") | fuzzy_ok, F.col("cv")).otherwise("")
    notes = (F.when(F.col("skip"), SKIPPED).when(F.col("exact"), EXACT)
             .when(fuzzy_ok, F.format_string("Fuzzy match (%d/%d words)", F.col("matched"), F.col("n_words")))
             .otherwise(NO_MATCH))
    return step.select("entity", "field_path", "ord", "url", "page_seq", *more, is_valid.alias("is_valid"),
                       source.alias("source_text"), notes.alias("notes"))


def validate_fields(leaves: DataFrame, pages: DataFrame, pages_per_cell: int = PAGES_PER_CELL,
                    run_ts: str | None = None) -> DataFrame:
    """pages(entity, url, page_seq, text): text is the page's plain text."""
    pg = pages.select("entity", "url", "page_seq", normalise(F.col("text")).alias("content_norm"))
    return check_fields(pair_leaves_with_pages(prepare_leaves(leaves), pg, pages_per_cell), run_ts)


def summary(results: DataFrame, keys: list[str]) -> DataFrame:
    """total, valid, invalid, rate (percent), exact, fuzzy, not-published count
    (notes containing 'Not published': every skipped value, as reported)."""
    return results.groupBy(*keys).agg(
        F.count("*").alias("total_fields"),
        F.count_if("is_valid").alias("valid_fields"),
        F.count_if(~F.col("is_valid")).alias("invalid_fields"),
        (F.count_if("is_valid") * F.lit(100.0) / F.count("*")).alias("validation_rate"),
        F.count_if(F.col("notes").contains("Exact match")).alias("exact_matches"),
        F.count_if(F.col("notes").contains("Fuzzy match")).alias("fuzzy_matches"),
        F.count_if(F.col("notes").contains(vocab.NOT_PUBLISHED)).alias("not_published"))


def section_of(path: Column) -> Column:
    return F.regexp_extract(path, "^([^.\\[]*)", 1)


def rollup(results: DataFrame) -> DataFrame:
    r = results.withColumn("section", section_of(F.col("field_path")))
    return r.rollup("entity", "section").agg(
        F.count("*").alias("total_fields"), F.count_if("is_valid").alias("valid_fields"),
        F.grouping_id().cast("int").alias("level"))


def verdicts(results: DataFrame) -> DataFrame:
    """Per leaf: valid on any page, and the first page (page order) that
    validates it."""
    return results.groupBy("entity", "field_path").agg(
        F.bool_or("is_valid").alias("valid_anywhere"),
        F.min_by(F.when(F.col("is_valid"), F.col("url")), F.when(F.col("is_valid"), F.col("page_seq")))
        .alias("first_source_url"),
        F.count("*").alias("pages_checked"))


def structure_issues(schema_paths: DataFrame, data_nodes: DataFrame, full_types: bool = False) -> DataFrame:
    """schema_paths(path, kind, ord) x sites vs data_nodes(entity, path, kind).

    Paths are arrays of keys, so a key with a dot is one step; issues show them
    joined.  Missing path -> 'Missing required field: p'; schema object but data
    not an object -> 'Type mismatch at p: expected dict'.  Children of a missing
    or mismatched node are not reported.  ``full_types`` also reports other kind
    differences (the documented stricter check)."""
    sites = data_nodes.select("entity").distinct()
    cand = sites.crossJoin(schema_paths)     # one row a site and schema path, which is the output's bound
    j = cand.join(data_nodes.select("entity", "path", F.col("kind").alias("data_kind")), ["entity", "path"], "left")
    mismatch = (F.col("kind") == "object") & (F.col("data_kind") != "object")
    if full_types:
        mismatch = mismatch | ((F.col("kind") != "object") & (F.col("data_kind") != F.col("kind"))
                               & (F.col("data_kind") != "null"))
    shown = F.array_join("path", ".")
    raw = j.where(F.col("data_kind").isNull() | mismatch).select(
        "entity", "path", "ord",
        F.when(F.col("data_kind").isNull(), F.concat(F.lit("Missing required field: "), shown))
        .when(F.col("kind") == "object", F.concat(F.lit("Type mismatch at "), shown, F.lit(": expected dict")))
        .otherwise(F.concat(F.lit("Type mismatch at "), shown, F.lit(": expected "), F.col("kind")))
        .alias("issue"))
    # drop issues under an already reported ancestor
    above = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.slice("path", 1, i))
    anc = raw.where(F.size("path") > 1).select("entity", "path", F.explode(above).alias("anc"))
    covered = anc.join(raw.select("entity", F.col("path").alias("anc")), ["entity", "anc"]).select("entity", "path")
    return (raw.join(covered.distinct(), ["entity", "path"], "left_anti")
            .withColumn("path", F.array_join("path", ".")))
