"""Keyword presence for large vocabularies.

Flat ``contains`` expressions are right for the default vocabularies (a few
dozen terms) and stay in generated code.  A vocabulary of thousands of terms
would make plans huge and cost |text| x |vocab|.  Here the vocabulary stays a
table of any size: each keyword is filed under its first characters (at most
``GRAM``), a text's distinct character runs of those lengths are joined to it,
and the candidates are verified against the whole text.  Runs that no keyword can be
filed under don't leave their task: a filter of fixed size, hashed from the
vocabulary's runs, drops them first, so what is joined grows with the texts' candidates
and not with their characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.operators.sections import confidence

GRAM = 4


def vocab_table(spark, sections: dict[str, list[str]]) -> DataFrame:
    rows = [(s, i, k) for i, (s, ks) in enumerate(sections.items()) for k in ks]
    return spark.createDataFrame(rows, "section string, section_ord int, keyword string")


#: Bits of the filter; a run that no keyword is filed under passes with a chance of
#: about the keywords' number by this.
FILTER_BITS = 1 << 20


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _places(codes: np.ndarray, size: int) -> np.ndarray:
    """The filter's bit of each run of ``size`` characters, by the run's start."""
    n = len(codes) - size + 1
    h = np.full(max(n, 0), size, dtype=np.uint64)
    for k in range(size):
        h = (h ^ codes[k:k + n] if n > 0 else h) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter(filed: DataFrame) -> dict[int, np.ndarray]:
    """Per length the bits that the keywords' runs set: of fixed size, whatever the
    vocabulary's, so it goes to every task.  Each task sets the bits of its keywords."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = set()
        for batch in batches:
            for run in batch.column("run").to_pylist():
                found.add((len(run), int(_places(_codes(run), len(run))[0])))
        size, place = zip(*sorted(found)) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(size, pa.int32()), pa.array(place, pa.int64())], names=["size", "place"])

    marked = filed.select("run").mapInArrow(bits, "size int, place long").distinct()
    packed = (marked.withColumn("byte", F.shiftright("place", 3).cast("int"))
              .groupBy("size", "byte").agg(F.bit_or(F.expr("shiftleft(1, cast(place % 8 AS int))")).alias("bits")))
    out: dict[int, np.ndarray] = {}
    for r in packed.toLocalIterator():       # small rows, GRAM * FILTER_BITS / 8 at most
        out.setdefault(r["size"], np.zeros(FILTER_BITS // 8, dtype=np.uint8))[r["byte"]] = r["bits"]
    return {size: np.unpackbits(b, bitorder="little").astype(bool) for size, b in out.items()}


def _asked_runs(texts: DataFrame, marks: dict[int, np.ndarray]) -> DataFrame:
    """texts(entity, page_id, low) -> (entity, page_id, run): the distinct runs of 1 to
    GRAM characters of each text that pass the filter."""
    marks_of = texts.sparkSession.sparkContext.broadcast(marks)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = marks_of.value
        for batch in batches:
            rows, runs = [], []
            for at, low in enumerate(batch.column("low")):
                low = low.as_py()
                codes = _codes(low)
                for size, mark in marks.items():
                    hit = np.flatnonzero(mark[_places(codes, size)]) if len(codes) >= size else ()
                    for run in {low[i:i + size] for i in hit}:
                        rows.append(at)
                        runs.append(run)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("entity").take(rows), batch.column("page_id").take(rows), pa.array(runs, pa.string())],
                names=["entity", "page_id", "run"])

    kinds = dict(texts.dtypes)
    return texts.mapInArrow(find, f"entity {kinds['entity']}, page_id {kinds['page_id']}, run string")


def matched_terms(pages: DataFrame, text_col: str, vocab: DataFrame) -> DataFrame:
    """pages(entity, page_id, <text>) -> (entity, page_id, keyword) for every
    distinct non-empty keyword that occurs as a substring of the lower-cased text."""
    texts = pages.select("entity", "page_id", F.lower(text_col).alias("low")).where(F.col("low").isNotNull())
    filed = vocab.where("keyword <> ''").select("keyword", F.substring("keyword", 1, GRAM).alias("run")).distinct()
    met = (_asked_runs(texts, _filter(filed)).join(filed, "run").select("entity", "page_id", "keyword").distinct())
    # the candidates of a page meet its text once
    listed = met.groupBy("entity", "page_id").agg(F.collect_list("keyword").alias("keywords"))
    held = F.filter("keywords", lambda k: F.contains(F.col("low"), k))
    return (texts.join(listed, ["entity", "page_id"]).select("entity", "page_id", F.explode(held).alias("keyword"))
            .distinct())


def page_sections_large(pages: DataFrame, text_col: str, vocab: DataFrame) -> DataFrame:
    """Same output as ``sections.page_sections``: hits = number of the
    section's list entries present in the text."""
    hits = matched_terms(pages, text_col, vocab).join(vocab, "keyword")
    agg = hits.groupBy("entity", "page_id", "section", "section_ord").agg(F.count("*").cast("int").alias("hits"))
    return agg.select("entity", "page_id", "section", "section_ord", "hits", confidence(F.col("hits")).alias("confidence"))
