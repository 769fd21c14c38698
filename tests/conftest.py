import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from sitelens.session import build_session
    s = build_session("local[8]", app="sitelens-tests", shuffle_partitions=8)
    yield s
    s.stop()


def pages_df(spark, rows):
    """rows: (page_id, url, html) -> pages with entity and page_seq."""
    from pyspark.sql import functions as F
    from sitelens.functions.urls import authority
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.select("page_id", "url", "html", authority(F.col("url")).alias("entity"),
                     F.col("page_id").alias("page_seq"))
