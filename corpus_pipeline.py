"""Corpus preparation: the stages applied to ``documents``, one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitelens.llm import common, decontaminate, exact_dedup, sentencepieces, simhash, toxicity


@common.stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, common.table(spark, sf_dir, "labels"))


@common.stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest id."""
    return exact_dedup.drop_copies(docs)


@common.stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document of the smallest id stays."""
    return simhash.keep_first(docs, shingle=3, max_distance=3)


@common.stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


@common.stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids; each is decoded again for the check."""
    return sentencepieces.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentence pieces", encode),
]

#: No twin: classifier, fingerprints and pieces have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is stored in the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
