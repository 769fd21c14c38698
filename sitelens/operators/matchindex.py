"""Field validation through an index of page words: only pairs that can match are compared.

A leaf of n words holds on a page if its text or at least three quarters of its words
are substrings of the page's text.  A word has no white space, so it is a substring of
the text just if it is one of a single page word.  Hence:

1. a site's pages are dealt over cells of about ``CHARS_PER_CELL`` characters, and the
   site's leaves go to each of its cells;
2. in a cell every different page word is looked through once for the leaves' words, by
   its runs of characters that are as long as the start of one of them, which gives each
   word the pages it stands on;
3. of n words of which m must stand on a page, one of any n - m + 1 must: the rarest
   n - m + 1 give the candidate pages, and only these are compared with the whole leaf;
4. a cell returns a row for each leaf it holds, with counts and its first page, so the
   pairs themselves are nowhere kept or sent;
5. leaves that hold on every page (skipped ones and empty texts) and pairs that are no
   candidates are counted from the number of the site's pages, not visited.

The work of 2. grows with the pages' words, times the different lengths of those starts
(``START`` at most).  Leaves are sent once a cell: a row for each leaf and ``CHARS_PER_CELL``
characters of its site.

A page may count several times (``times``), as in a record's list of URLs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.operators import validate as VD
from sitelens.session import cut_lineage

#: Characters of a site's normalised page texts that one cell holds.
CHARS_PER_CELL = 8_000_000
#: Characters of a word that a page word is looked through for; the rest is compared then.
START = 24


def words_on_pages(words: dict[str, int], texts: list[str]) -> list[np.ndarray]:
    """For each text the numbers of the ``words`` (word -> number) that are substrings of it."""
    starts: dict[str, list[str]] = {}
    for w in words:
        starts.setdefault(w[:START], []).append(w)
    lengths = {len(s) for s in starts}
    known: dict[str, set[int]] = {}

    def within(token: str) -> set[int]:
        return {words[w] for n in lengths for i in range(len(token) - n + 1)
                for w in starts.get(token[i:i + n], ()) if token.startswith(w, i)}

    out = []
    for text in texts:
        found: set[int] = set()
        for token in set(text.split(" ")):
            held = known.get(token)
            if held is None:
                held = known[token] = within(token)
            found.update(held)
        out.append(np.fromiter(found, np.int64, len(found)))
    return out


def compared(values: list[str], texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(leaf, pages, matched, exact)`` for each of the normalised ``values``: the candidate
    pages among ``texts``, ascending, the value's words that stand on each, and whether the
    value does as a whole."""
    asked = [v.split(" ") for v in values]
    number = {w: k for k, w in enumerate(dict.fromkeys(w for words in asked for w in words))}
    present = words_on_pages(number, texts)
    word = np.concatenate([np.empty(0, np.int64), *present])
    page = np.repeat(np.arange(len(texts)), [len(p) for p in present])[np.argsort(word, kind="stable")]
    ends = np.cumsum(np.bincount(word, minlength=len(number)))
    posting = [page[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    for leaf, (value, words) in enumerate(zip(values, asked)):
        lists = [posting[number[w]] for w in words]
        if len(words) == 1:                   # stands there exactly, just where its word does
            yield leaf, lists[0], np.ones(len(lists[0]), np.int64), np.ones(len(lists[0]), bool)
            continue
        probes = len(words) - math.ceil(len(words) * vocab.FUZZY_SHARE) + 1
        pages = np.unique(np.concatenate(sorted(lists, key=len)[:probes]))
        matched = np.zeros(len(pages), np.int64)
        for held in filter(len, lists):
            matched += held[np.minimum(np.searchsorted(held, pages), len(held) - 1)] == pages
        exact = np.array([m == len(words) and value in texts[p] for p, m in zip(pages, matched)], bool)
        yield leaf, pages, matched, exact


def _cell(leaves: pa.Table, pages: pa.Table) -> tuple[list[dict], list[dict], Iterator]:
    """The rows of a cell, pages in their order, and what was compared."""
    rows, on = leaves.to_pylist(), pages.to_pylist()
    on.sort(key=lambda p: tuple((p[k] is not None, p[k]) if p[k] is not None else (False,) for k in ("page_seq", "url")))
    if not rows or not on:
        return rows, on, iter(())
    return rows, on, compared([r["cv"] for r in rows], [p["content_norm"] for p in on])


def _leaf_counts(leaves: pa.Table, pages: pa.Table) -> pa.Table:
    rows, on, found = _cell(leaves, pages)
    times = np.array([p["times"] for p in on], np.int64)
    out = []
    for leaf, at, matched, exact in found:
        row = rows[leaf]
        valid = exact | (matched >= (row["cv"].count(" ") + 1) * vocab.FUZZY_SHARE)
        if valid.any():
            n, first = times[at] * row["same"], on[at[valid.argmax()]]
            out.append((row["entity"], row["field_path"], first["url"], first["page_seq"], int(n[valid].sum()),
                        int(n[exact].sum()), int(n[valid & ~exact].sum())))
    return _table(out, pages, [("valid", pa.int64()), ("exact", pa.int64()), ("fuzzy", pa.int64())])


def _pairs(leaves: pa.Table, pages: pa.Table) -> pa.Table:
    rows, on, found = _cell(leaves, pages)
    out = [(r["entity"], r["field_path"], on[p]["url"], on[p]["page_seq"], r["ord"], r["same"], on[p]["times"], False,
            r["cv"], r["cv"].count(" ") + 1, int(m), bool(e))
           for leaf, at, matched, exact in found for r in [rows[leaf]] for p, m, e in zip(at, matched, exact)]
    return _table(out, pages, [("ord", pa.int32()), ("same", pa.int64()), ("times", pa.int64()), ("skip", pa.bool_()),
                               ("cv", pa.string()), ("n_words", pa.int32()), ("matched", pa.int32()),
                               ("exact", pa.bool_())])


def _table(rows: list[tuple], pages: pa.Table, more: list[tuple]) -> pa.Table:
    schema = pa.schema([("entity", pa.string()), ("field_path", pa.string()), ("url", pa.string()),
                        ("page_seq", pages.schema.field("page_seq").type), *more])
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


class IndexedValidation:
    """Validation results of leaves(entity, field_path, kind, value, ord) on pages(entity,
    url, page_seq, text[, times]), held as counts of the leaves.

    ``found``: a row for each cell and leaf that holds on some of its pages.  ``everywhere``:
    the leaves that hold on every page.  ``sizes``: the site's pages.  ``matches``: the
    compared pairs, computed when asked for; all other pairs match nowhere."""

    def __init__(self, leaves: DataFrame, pages: DataFrame, chars_per_cell: int = CHARS_PER_CELL):
        times = F.col("times") if "times" in pages.columns else F.lit(1)
        self.pages = cut_lineage(pages.select("entity", "url", "page_seq", times.cast("bigint").alias("times"),
                                              VD.normalise(F.col("text")).alias("content_norm")))
        # rows that are equal in all this are one leaf that counts ``same`` times
        one = leaves.groupBy("entity", "field_path", "kind", "value", "ord").agg(F.count(F.lit(1)).alias("same"))
        self.leaves = cut_lineage(VD.prepare_leaves(one).drop("words"))
        self.everywhere = self.leaves.where(F.col("skip") | (F.col("cv") == ""))
        self.sizes = self.pages.groupBy("entity").agg(
            F.sum("times").alias("n_pages"), F.min(F.struct("page_seq", "url")).alias("first_page"))
        self._chars = chars_per_cell
        self.found = self._by_cell(_leaf_counts, "valid bigint, exact bigint, fuzzy bigint")

    @property
    def matches(self) -> DataFrame:
        """The compared pairs, as ``validate_fields`` gives them, with ``same`` and ``times``."""
        pairs = self._by_cell(_pairs, "ord int, same bigint, times bigint, skip boolean, cv string, "
                                      "n_words int, matched int, exact boolean")
        return VD.judged(pairs, ("same", "times"))

    def _by_cell(self, work, more: str) -> DataFrame:
        """``entity, field_path, url, page_seq`` and the columns ``more`` of ``work`` on each cell."""
        texts = self.pages.where(F.col("entity").isNotNull() & (F.col("content_norm") != ""))
        parts = texts.groupBy("entity").agg(
            F.ceil(F.sum(F.char_length("content_norm")) / self._chars).alias("_parts"))
        cell = F.pmod(F.xxhash64("page_seq", "url"), F.col("_parts")).alias("cell")
        dealt = texts.join(parts, "entity").select("entity", cell, "url", "page_seq", "times", "content_norm")
        cells = parts.select("entity", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("cell"))
        leaves = (self.leaves.where(~F.col("skip") & (F.col("cv") != "")).join(cells, "entity")
                  .select("entity", "cell", "field_path", "ord", "same", "cv"))
        seq = self.pages.schema["page_seq"].dataType.simpleString()
        return leaves.groupBy("entity", "cell").cogroup(dealt.groupBy("entity", "cell")).applyInArrow(
            work, f"entity string, field_path string, url string, page_seq {seq}, {more}")

    def _per_leaf(self) -> DataFrame:
        """``entity, field_path, total, valid, exact, fuzzy, skipped, first`` by field path."""
        found = self.found.groupBy("entity", "field_path").agg(
            F.sum("valid").alias("valid"), F.sum("exact").alias("exact"), F.sum("fuzzy").alias("fuzzy"),
            F.min(F.struct("page_seq", "url")).alias("first"))
        held = self.everywhere.groupBy("entity", "field_path").agg(
            F.sum("same").alias("always"), F.sum(F.when(F.col("skip"), F.col("same")).otherwise(0)).alias("skip"))
        all_ = self.leaves.groupBy("entity", "field_path").agg(F.sum("same").alias("leaves"))
        zero = lambda c: F.coalesce(c, F.lit(0))
        pages = F.col("n_pages")
        return (all_.join(self.sizes, "entity").join(found, ["entity", "field_path"], "left")
                .join(held, ["entity", "field_path"], "left")
                .select("entity", "field_path", (F.col("leaves") * pages).alias("total"),
                        (zero("valid") + zero("always") * pages).alias("valid"),
                        (zero("exact") + (zero("always") - zero("skip")) * pages).alias("exact"),
                        zero("fuzzy").alias("fuzzy"), (zero("skip") * pages).alias("skipped"),
                        F.when(zero("always") > 0, F.col("first_page")).otherwise(F.col("first")).alias("first")))

    def summary(self, keys: list[str] | None = None) -> DataFrame:
        """As ``validate.summary`` of all pairs; ``keys`` among entity and field_path."""
        return self._per_leaf().groupBy(*(keys or ["entity"])).agg(
            F.sum("total").alias("total_fields"), F.sum("valid").alias("valid_fields"),
            (F.sum("total") - F.sum("valid")).alias("invalid_fields"),
            (F.sum("valid") * F.lit(100.0) / F.sum("total")).alias("validation_rate"),
            F.sum("exact").alias("exact_matches"), F.sum("fuzzy").alias("fuzzy_matches"),
            F.sum("skipped").alias("not_published"))

    def verdicts(self) -> DataFrame:
        """As ``validate.verdicts`` of all pairs."""
        return self._per_leaf().select("entity", "field_path", (F.col("valid") > 0).alias("valid_anywhere"),
                                       F.col("first.url").alias("first_source_url"), F.col("total").alias("pages_checked"))

    def rollup(self) -> DataFrame:
        """As ``validate.rollup`` of all pairs."""
        rows = self._per_leaf().withColumn("section", VD.section_of(F.col("field_path")))
        return rows.rollup("entity", "section").agg(
            F.sum("total").alias("total_fields"), F.sum("valid").alias("valid_fields"),
            F.grouping_id().cast("int").alias("level"))
