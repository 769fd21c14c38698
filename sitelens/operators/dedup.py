"""Duplicate-content detection: exact copies after case and whitespace
normalisation, keyed by a SHA-256 of the normalised text.

Grouping is a hash aggregate with map-side combine, so a text copied a
billion times costs one partial row per map task; the keep-list is joined
back on the unique document key, never on the (possibly hot) hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.text import squash_ws


def content_hash(text_col: str) -> F.Column:
    return F.sha2(squash_ws(F.lower(F.col(text_col))), 256)


def duplicate_groups(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    g = docs.select(key, content_hash(text_col).alias("content_hash")).groupBy("content_hash").agg(
        F.count("*").alias("n_copies"), F.min(key).alias(f"keep_{key}"))
    return g.where(F.col("n_copies") > 1)


def keep_first(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """One row per distinct content: the copy with the smallest key."""
    hashed = docs.withColumn("content_hash", content_hash(text_col))
    keep = hashed.groupBy("content_hash").agg(F.min(key).alias(key))
    return hashed.join(keep.select(key), key, "left_semi")
