import datetime as dt

from sitelens.operators import usage as US


def calls_df(spark, rows):
    return spark.createDataFrame(rows, "caller string, ts timestamp, call_id bigint, prompt_tokens bigint, completion_tokens bigint")


def test_gap_boundary_is_strict(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("c", t0, 1, 10, 0), ("c", t0 + dt.timedelta(seconds=60), 2, 10, 0),
            ("c", t0 + dt.timedelta(seconds=120, microseconds=1), 3, 10, 0)]
    out = sorted(US.rate_windows(calls_df(spark, rows), tpm=15).collect(), key=lambda r: r.call_id)
    assert [r.session_start for r in out] == [True, False, True]
    assert [r.minute_tokens for r in out] == [0, 10, 0]
    assert [r.minute_requests for r in out] == [0, 1, 0]
    assert [r.tokens_used for r in out] == [0, 10, 20]
    assert [r.must_wait for r in out] == [False, True, False]


def test_chunked_scan_equals_single_chunk(spark):
    import random
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows, cid = [], 0
    for c in ("a", "b", "c"):
        t = t0
        for _ in range(300):
            t += dt.timedelta(seconds=rng.choice([5, 30, 59, 60, 61, 200, 3600, 7200]))
            cid += 1
            rows.append((c, t, cid, rng.randint(0, 50), rng.randint(0, 50)))
    df = calls_df(spark, rows)
    fine = {r.call_id: tuple(r) for r in US.rate_windows(df, 60, chunk_seconds=600).collect()}
    whole = {r.call_id: tuple(r) for r in US.rate_windows(df, 60, chunk_seconds=10 ** 9).collect()}
    assert fine == whole


def test_token_estimate_and_cost(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "abcd"), (1, "abc"), (1, None)], "k int, text string")
    assert df.groupBy("k").agg(US.token_estimate(F.col("text")).alias("t")).collect()[0].t == 1
    c = spark.range(1).select(US.call_cost(F.lit(1000), F.lit(1000)).alias("c")).collect()[0].c
    assert abs(c - 0.09) < 1e-12
