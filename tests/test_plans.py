"""Physical-plan properties the design relies on."""

import contextlib
import io

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", str(2 ** 30))
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()
    finally:
        spark.conf.set("spark.sql.maxPlanStringLength", old)


def test_top_k_is_limited_before_the_shuffle(spark):
    p = plan(E.queries()["top_links_per_site"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "partial_min" in p        # first occurrence per URL combines map-side


def test_first_three_attempts_limited_before_shuffle(spark):
    p = plan(E.queries()["url_status"](spark, SF))
    assert "WindowGroupLimit" in p


def test_usage_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["token_cost"](spark, SF))
    schema = [line for line in p.splitlines() if "ReadSchema" in line][0]
    assert "user_id" in schema and "props" in schema and "value" in schema
    assert "event_type" not in schema and "ts" not in schema


def test_duplicate_groups_combine_map_side(spark):
    p = plan(E.queries()["duplicate_content"](spark, SF))
    assert "partial_count" in p and "partial_min" in p


def test_no_python_udf_in_native_queries(spark):
    for name in ["page_links", "top_links_per_site", "page_sections", "page_plain_text", "rate_sessions"]:
        p = plan(E.queries()[name](spark, SF))
        assert "Python" not in p and "ArrowEval" not in p, name
