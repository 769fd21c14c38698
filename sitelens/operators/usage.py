"""Token usage, cost and rate-limit windows over a call log.

Rate limiting works on gap sessions: the per-minute counters reset when
more than ``gap`` seconds passed since the previous call (a gap of exactly
``gap`` stays in the session); the daily budget never resets.  Checks run
before a call, so every running value excludes the call itself.

Running sums per caller are computed as a two-level scan so no caller's
whole history sits in one task: rows are cut into time chunks per caller;
windows run inside (caller, chunk); one small row per chunk carries the
session state across chunks (a segmented scan over chunk summaries).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens import vocab


def calls_from_events(events: DataFrame) -> DataFrame:
    """Derived call log: caller = user, prompt tokens = props.k, completion
    tokens = int(value)."""
    return events.select(
        F.col("user_id").alias("caller"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("call_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("prompt_tokens"),
        F.col("value").cast("int").cast("bigint").alias("completion_tokens"))


def token_estimate(texts: Column) -> Column:
    """floor(sum of message lengths / 4); missing text counts 0."""
    return F.floor(F.sum(F.length(F.coalesce(texts, F.lit("")))) / vocab.CHARS_PER_TOKEN).cast("bigint")


def call_cost(prompt: Column, completion: Column,
              prompt_rate: float = vocab.PROMPT_COST_PER_1K,
              completion_rate: float = vocab.COMPLETION_COST_PER_1K) -> Column:
    return prompt / F.lit(1000.0) * F.lit(prompt_rate) + completion / F.lit(1000.0) * F.lit(completion_rate)


def usage_totals(calls: DataFrame, keys: list[str]) -> DataFrame:
    c = calls.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))
    return c.groupBy(*keys).agg(
        F.count("*").alias("requests"), F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"), F.sum("total_tokens").alias("total_tokens"),
        # from the exact token sums: no order of addition changes it
        F.round(call_cost(F.sum("prompt_tokens"), F.sum("completion_tokens")), 6).alias("cost"))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def segmented_running(df: DataFrame, key: str, ts: str, tie: str, value: str, gap_seconds: float | None,
                      chunk_seconds: int = 86400) -> DataFrame:
    """Adds ``session_start`` (bool), ``sess_sum_before`` / ``sess_cnt_before``
    (sum / count of earlier rows in the same gap session) and
    ``cum_sum_before`` / ``cum_cnt_before`` (over all earlier rows of the key).
    ``gap_seconds=None`` means one session per key."""
    gap_us = None if gap_seconds is None else int(round(gap_seconds * 1_000_000))
    us = _micros(F.col(ts))
    d = df.withColumn("_us", us).withColumn("_chunk", F.floor(F.col("_us") / F.lit(chunk_seconds * 1_000_000)))
    wl = Window.partitionBy(key, "_chunk").orderBy("_us", tie)
    prev = F.lag("_us").over(wl)
    inner = F.lit(False) if gap_us is None else F.coalesce((F.col("_us") - prev) > F.lit(gap_us), F.lit(False))
    d = d.withColumn("_first", prev.isNull()).withColumn("_inner", inner & ~F.col("_first"))
    d = d.withColumn("_seg", F.sum(F.col("_inner").cast("int")).over(wl.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_v", F.coalesce(F.col(value), F.lit(0)))

    d = d.withColumn("_maxseg", F.max("_seg").over(Window.partitionBy(key, "_chunk")))

    # one row per (key, chunk); d is already clustered on (key, chunk)
    in_tail = (F.col("_seg") == F.col("_maxseg")) & (F.col("_maxseg") > 0)
    ch = d.groupBy(key, "_chunk").agg(
        F.min("_us").alias("first_us"), F.max("_us").alias("last_us"),
        F.sum("_v").alias("tot_sum"), F.count("*").alias("tot_cnt"), F.max("_seg").alias("max_seg"),
        F.sum(F.when(in_tail, F.col("_v"))).alias("tail_sum"), F.count(F.when(in_tail, F.lit(1))).alias("tail_cnt"))
    wc = Window.partitionBy(key).orderBy("_chunk")
    prev_last = F.lag("last_us").over(wc)
    if gap_us is None:
        first_reset = prev_last.isNull()
    else:
        first_reset = prev_last.isNull() | ((F.col("first_us") - prev_last) > F.lit(gap_us))
    ch = ch.withColumn("first_reset", first_reset)
    inner_reset = F.col("max_seg") > 0
    start_sum = F.when(inner_reset, F.col("tail_sum")).otherwise(F.col("tot_sum"))
    start_cnt = F.when(inner_reset, F.col("tail_cnt")).otherwise(F.col("tot_cnt"))
    resets = F.col("first_reset") | inner_reset
    upto = wc.rowsBetween(Window.unboundedPreceding, 0)
    ch = (ch.withColumn("S", F.sum("tot_sum").over(upto)).withColumn("C", F.sum("tot_cnt").over(upto))
          .withColumn("_r", F.last(F.when(resets, F.struct(F.col("S").alias("S"), F.col("C").alias("C"),
                                                         start_sum.alias("ss"), start_cnt.alias("sc"))),
                                   ignorenulls=True).over(upto)))
    ch = (ch.withColumn("end_sum", F.col("_r.ss") + F.col("S") - F.col("_r.S"))
          .withColumn("end_cnt", F.col("_r.sc") + F.col("C") - F.col("_r.C")))
    ch = (ch.withColumn("carry_sum", F.when(F.col("first_reset"), F.lit(0)).otherwise(F.lag("end_sum").over(wc)))
          .withColumn("carry_cnt", F.when(F.col("first_reset"), F.lit(0)).otherwise(F.lag("end_cnt").over(wc)))
          .withColumn("cum_sum0", F.col("S") - F.col("tot_sum")).withColumn("cum_cnt0", F.col("C") - F.col("tot_cnt")))
    d = d.join(ch.select(key, "_chunk", "first_reset", "carry_sum", "carry_cnt", "cum_sum0", "cum_cnt0"),
               [key, "_chunk"])
    ws = Window.partitionBy(key, "_chunk", "_seg").orderBy("_us", tie).rowsBetween(Window.unboundedPreceding, -1)
    wa = wl.rowsBetween(Window.unboundedPreceding, -1)
    loc_sum = F.coalesce(F.sum("_v").over(ws), F.lit(0))
    loc_cnt = F.count("_v").over(ws)
    in_carry = F.col("_seg") == 0
    d = d.select(
        *df.columns,
        (F.col("_inner") | (F.col("_first") & F.col("first_reset"))).alias("session_start"),
        (loc_sum + F.when(in_carry, F.col("carry_sum")).otherwise(F.lit(0))).cast("bigint").alias("sess_sum_before"),
        (loc_cnt + F.when(in_carry, F.col("carry_cnt")).otherwise(F.lit(0))).cast("bigint").alias("sess_cnt_before"),
        (F.col("cum_sum0") + F.coalesce(F.sum("_v").over(wa), F.lit(0))).cast("bigint").alias("cum_sum_before"),
        (F.col("cum_cnt0") + F.count("_v").over(wa)).cast("bigint").alias("cum_cnt_before"))
    return d


def rate_windows(calls: DataFrame, gap_seconds: float = vocab.RATE_WINDOW_SECONDS,
                 tpm: int = vocab.TOKENS_PER_MINUTE, rpm: int = vocab.REQUESTS_PER_MINUTE,
                 tpd: int = vocab.TOKENS_PER_DAY, chunk_seconds: int = 86400) -> DataFrame:
    """Per call: session start, minute counters and daily total before the call,
    and the three limit flags; ``must_wait`` = estimate (prompt tokens) +
    minute tokens > TPM."""
    c = calls.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))
    r = segmented_running(c, "caller", "ts", "call_id", "total_tokens", gap_seconds, chunk_seconds)
    return r.select(
        "caller", "call_id", "ts", "session_start",
        F.col("sess_sum_before").alias("minute_tokens"), F.col("sess_cnt_before").alias("minute_requests"),
        F.col("cum_sum_before").alias("tokens_used"),
        (F.col("sess_sum_before") >= tpm).alias("tpm_blocked"),
        (F.col("sess_cnt_before") >= rpm).alias("rpm_blocked"),
        (F.col("cum_sum_before") >= tpd).alias("tpd_blocked"),
        ((F.col("prompt_tokens") + F.col("sess_sum_before")) > tpm).alias("must_wait"))
