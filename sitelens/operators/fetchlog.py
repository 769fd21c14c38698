"""URL accessibility from a fetch log.

A URL is accessible iff one of its first three attempts returned 200 (the
retry loop stops at the first success).  ``row_number() <= 3`` per URL is
planned with a partial WindowGroupLimit, so a URL with a huge log only
ships three rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens import vocab

WELL_FORMED_RE = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\s]+"


def fetch_log_from_events(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Derived log: URL = page number ``user_id mod n_pages``; status 500 for
    'error' events, else 200."""
    n = pages.agg(F.count("*").alias("n"))  # one row
    ev = events.crossJoin(F.broadcast(n)).select(
        F.pmod(F.col("user_id"), F.col("n")).alias("page_id"), "ts", "event_id",
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))
    return ev.join(pages.select("page_id", "url"), "page_id").select("url", "ts", "event_id", "status")


def url_status(log: DataFrame, urls: DataFrame, attempts: int = vocab.URL_ATTEMPTS) -> DataFrame:
    """urls(url) x log(url, ts, event_id, status) -> (url, accessible,
    attempts_used, well_formed).  URLs without log rows are inaccessible."""
    w = Window.partitionBy("url").orderBy("ts", "event_id")
    first = log.withColumn("attempt", F.row_number().over(w)).where(F.col("attempt") <= attempts)
    ok_at = F.min(F.when(F.col("status") == 200, F.col("attempt")))
    st = first.groupBy("url").agg(ok_at.alias("ok_at"), F.count("*").alias("n_attempts"))
    u = urls.select("url").distinct().join(st, "url", "left")
    return u.select("url", F.col("ok_at").isNotNull().alias("accessible"),
                    F.coalesce(F.col("ok_at"), F.col("n_attempts"), F.lit(0)).cast("int").alias("attempts_used"),
                    well_formed(F.col("url")).alias("well_formed"))


def well_formed(url: Column) -> Column:
    return url.rlike(WELL_FORMED_RE)


def accessible_only(urls: DataFrame, status: DataFrame) -> DataFrame:
    """F8: keep URLs whose status is accessible (left semi join)."""
    return urls.join(status.where("accessible").select("url"), "url", "left_semi")
