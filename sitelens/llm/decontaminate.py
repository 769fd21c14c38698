"""Benchmark decontamination over a distributed positional inverted index.

1. Index: one posting ``(term, row, position)`` for each document word that
   occurs in the benchmark, stored as a table in the shared folder.
2. Each benchmark window (``size`` consecutive words of an item, or a whole
   shorter item) is reduced to its two terms with the fewest postings.  Windows
   of an item with the same two follow each other; together they are a spot, a
   passage of under ``2 * size`` words.  Equal spots of any items are one.
3. The posting lists of a spot's two terms, moved back by their offsets, are
   intersected: equal starts are phrase candidates, starts at most ``slack``
   apart proximity matches.
4. A phrase candidate is one row.  It meets the block of ``BLOCK`` words of its
   text that it starts in, and only its passage is compared with that block, so
   a passage that a text repeats costs the same each time.

The index and the intersection use ``lower``, which is coarser than the A-Z
lowering of the definition; the comparison is exact.  Documents are never
grouped by term: the joins are on (row, spot, start) and (row, block), which no
frequent word or passage makes large for one task.  A row goes by 128 bits of
its id and text.  Two spots of equal 64-bit number would be compared both.

Defined cases: null text has no words; an item without words has no window; rows
that repeat are judged each; a null ``item_id`` marks words but is not listed; a
text may be of any length and repeat a passage any number of times; empty tables
give no hits.  Other columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound, materialize, text_or_empty, whole_row

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS, SLACK = 10, 3
#: Words of a text that a candidate is compared with, but for the overlap.
BLOCK = 256
#: The index holds one posting of this term for every document.
DOCUMENT = ""


def words_of(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def exact_words(text: Column) -> Column:
    return words_of(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def row_key(id_name: str) -> Column:
    """16 bytes of id and text; a null id is no string."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_name).cast("string"), F.lit("null")), F.lit("\n"),
                                  text_or_empty())))


def benchmark_items(bench: DataFrame) -> DataFrame:
    """Items with words: ``item, item_id, terms`` (coarse), ``words`` (exact)."""
    return (bench.select(row_key("item_id").alias("item"), F.col("item_id").cast("string").alias("item_id"),
                         words_of(F.lower(text_or_empty())).alias("terms"),
                         exact_words(text_or_empty()).alias("words"))
            .where(F.size("terms") > 0).dropDuplicates(["item"]))


def index(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The stored postings: ``term, doc_id, row, n_words, pos``."""
    vocabulary = materialize(items.select(F.explode("terms").alias("term")).distinct()
                             .union(items.sparkSession.range(1).select(F.lit(DOCUMENT).alias("term"))), "leak-terms")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key("doc_id").alias("row"),
                       words_of(F.lower(text_or_empty())).alias("w"))
    postings = rows.select("doc_id", "row", F.size("w").alias("n_words"),
                           F.posexplode(F.concat(F.array(F.lit(DOCUMENT)), F.col("w"))).alias("pos", "term"))
    return materialize(postings.join(vocabulary, "term", "left_semi")
                       .select("term", "doc_id", "row", "n_words", (F.col("pos") - 1).alias("pos")), "leak-index")


def anchors(items: DataFrame, postings: DataFrame, size: int) -> DataFrame:
    """The spots with the items that hold them: ``spot, item_id, words`` (exact), ``length``
    of its windows, its two rarest terms and their offsets in it."""
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("terms") - size, F.lit(0)))
    windows = items.select("item", "terms", F.explode(starts).alias("start"))
    places = windows.select("item", "start", F.posexplode(F.slice("terms", F.col("start") + 1, size)).alias("o", "term"))
    places = places.withColumn("off", F.col("start") + F.col("o"))
    window = Window.partitionBy("item", "start")
    ranked = (places.join(frequency, "term", "left")
              .withColumn("rank", F.row_number().over(window.orderBy(F.coalesce("n", F.lit(0)), "off")))
              .withColumn("last", F.least(F.lit(2), F.max("rank").over(window))))

    def at_rank(rank: Column, name: str) -> Column:
        return F.max(F.when(F.col("rank") == rank, F.col(name)))

    picked = ranked.groupBy("item", "start").agg(
        at_rank(F.lit(1), "term").alias("term1"), at_rank(F.lit(1), "off").alias("off1"),
        at_rank(F.col("last"), "term").alias("term2"), at_rank(F.col("last"), "off").alias("off2"))
    spans = (picked.groupBy("item", "term1", "off1", "term2", "off2")
             .agg(F.min("start").alias("low"), F.max("start").alias("high")))
    length = F.least(F.lit(size), F.size("words"))
    spots = spans.join(items.select("item", "item_id", "words"), "item").select(
        "item_id", "term1", (F.col("off1") - F.col("low")).alias("off1"),
        "term2", (F.col("off2") - F.col("low")).alias("off2"), length.alias("length"),
        F.slice("words", F.col("low") + 1, F.col("high") - F.col("low") + length).alias("words"))
    return spots.distinct().withColumn("spot", F.xxhash64("words", "length", "term1", "off1", "term2", "off2"))


def candidates(postings: DataFrame, spots: DataFrame, slack: int) -> DataFrame:
    """``row, spot, start`` (of the spot in the row) ``, phrase`` (the two lists agree exactly)."""
    lists = [postings.select(F.col("term").alias(f"term{k}"), "row", "pos")
             .join(spots.select(f"term{k}", "spot", f"off{k}"), f"term{k}")
             .select("row", "spot", (F.col("pos") - F.col(f"off{k}")).alias(f"start{k}")) for k in (1, 2)]
    cell = F.floor(F.col("start1") / (slack + 1))
    rare = lists[0].withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    other = lists[1].withColumn("cell", F.floor(F.col("start2") / (slack + 1)))
    return (rare.join(other, ["row", "spot", "cell"])
            .where(F.abs(F.col("start1") - F.col("start2")) <= slack)
            .groupBy("row", "spot", F.col("start1").alias("start"))
            .agg(F.max(F.col("start1") == F.col("start2")).alias("phrase")))


def phrase_matches(docs: DataFrame, found: DataFrame, spots: DataFrame, size: int) -> DataFrame:
    """``row, spot, start, length`` of each run of windows that occurs in a text."""
    tested = found.where("phrase").select("row", "spot", "start",
                                          F.floor(F.greatest("start", F.lit(0)) / BLOCK).cast("int").alias("block"))
    # the rows with candidates grow with the documents: never broadcast, one plan at every size
    texts = (docs.select(row_key("doc_id").alias("row"), text_or_empty().alias("text"))
             .join(tested.select("row").distinct().hint("merge"), "row", "left_semi"))

    def cut(words: Column) -> Column:
        last = F.floor(F.greatest(F.size(words) - 1, F.lit(0)) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(words, b * BLOCK + 1, BLOCK + 2 * size))

    blocks = texts.select("row", F.posexplode(bound(exact_words(F.col("text")), cut)).alias("block", "doc"))
    pairs = tested.join(blocks, ["row", "block"]).join(spots.select("spot", "words", "length"), "spot")
    at = F.col("start") - F.col("block") * BLOCK

    # every window of a spot holds its two terms, so those that occur follow each other
    same = F.filter(F.sequence(F.lit(0), F.size("words") - F.col("length")), lambda s: (F.col("start") + s >= 0) & (
        F.slice("doc", F.greatest(at + s, F.lit(0)) + 1, F.col("length")) == F.slice("words", s + 1, F.col("length"))))
    runs = pairs.select("row", "spot", "start", "length", same.alias("same")).where(F.size("same") > 0)
    return runs.select("row", "spot", (F.col("start") + F.col("same")[0]).alias("start"),
                       (F.col("length") + F.size("same") - 1).alias("length")).distinct()


def covered(exact: DataFrame) -> DataFrame:
    """``row, n_hit``: words under any of a row's matches, each once."""
    spans = exact.groupBy("row", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = F.max("end").over(Window.partitionBy("row").orderBy("start")
                               .rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce("before", "start"))
    return (spans.withColumn("before", before).groupBy("row")
            .agg(F.sum(F.greatest(fresh, F.lit(0))).cast("bigint").alias("n_hit")))


def search(docs: DataFrame, bench: DataFrame, size: int, slack: int) -> tuple[DataFrame, ...]:
    """The stored postings, spots with their items, candidates and exact matches."""
    items = materialize(benchmark_items(bench), "leak-items")
    postings = index(docs, items)
    held = materialize(anchors(items, postings.where(F.col("term") != DOCUMENT), size), "leak-anchors")
    spots = held.drop("item_id").distinct()
    found = materialize(candidates(postings, spots, slack), "leak-candidates")
    return postings, held, found, materialize(phrase_matches(docs, found, spots, size), "leak-matches")


def document_ids(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("term") == DOCUMENT).select("doc_id", "row", F.col("n_words").cast("bigint"))


def matches(docs: DataFrame, bench: DataFrame, size: int = WINDOW_WORDS, slack: int = SLACK) -> DataFrame:
    """One row per match: ``doc_id, item_id, kind`` (phrase, proximity) ``, start, length``: the words
    that windows of the item cover, or where the spot of a proximity match would begin, without a length."""
    postings, held, found, exact = search(docs, bench, size, slack)
    near = found.join(exact.select("row", "spot").distinct(), ["row", "spot"], "left_anti")
    spans = (exact.select("row", "spot", F.lit("phrase").alias("kind"), "start", "length")
             .union(near.select("row", "spot", F.lit("proximity"), "start", F.lit(None).cast("int"))))
    return (spans.join(held.select("spot", "item_id").distinct(), "spot").join(document_ids(postings), "row")
            .select("doc_id", "item_id", "kind", "start", "length"))


def contamination(docs: DataFrame, bench: DataFrame, size: int = WINDOW_WORDS, slack: int = SLACK) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, item_ids`` (sorted as strings) and
    ``n_near``, the items met in proximity only; ``row`` is ``row_key`` of it."""
    postings, held, found, exact = search(docs, bench, size, slack)
    met = (exact.select("row", "spot", F.lit(True).alias("hit"))
           .union(found.select("row", "spot", F.lit(False))).groupBy("row", "spot").agg(F.max("hit").alias("hit"))
           .join(held.select("spot", "item_id").distinct(), "spot").groupBy("row")
           .agg(F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("item_id")))).alias("item_ids"),
                F.collect_set("item_id").alias("met")))
    none = F.array().cast("array<string>")
    out = document_ids(postings).join(covered(exact), "row", "left").join(met, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce("item_ids", none).alias("item_ids"),
                      F.size(F.array_except(F.coalesce("met", none), F.coalesce("item_ids", none)))
                      .cast("bigint").alias("n_near"), "row")


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns kept whatever their
    names.  A row goes by its id and text: one that shares only the id with a hit stays."""
    hit = contamination(docs, bench).where("n_hit > 0").select(F.col("row").alias("key")).distinct()
    rows = docs.select(whole_row(docs).alias("row"), row_key("doc_id").alias("key"))
    return rows.join(hit, "key", "left_anti").select("row.*")
