import json

from pyspark.sql import functions as F

from conftest import pages_df
from sitelens.operators import merge as MG
from sitelens.plans import sitejob as J

NAV = ('<nav><a href="/adm">Admission requirements</a><a href="/cur">Program curriculum</a>'
       '<a href="/contact">Contact us</a></nav>')
SITE = [
    (0, "http://h.x/", f"<html lang='en'><title>Home</title><body>{NAV}<article><h1>Welcome</h1>"
                       "<p>Our requirement list and GPA rules.</p></article></body></html>"),
    (1, "http://h.x/adm", '<html lang="en"><title>Admissions</title><body><article><p>Deadline date and timeline.</p>'
                          '<a href="/int">Interview day</a></article></body></html>'),
    (2, "http://h.x/cur", '<html lang="en"><title></title><body><article><p>Curriculum course rotation.</p>'
                          '</article></body></html>'),
    (3, "http://h.x/int", '<html lang="en"><title>Interviews</title><body><article><p>Interview MMI visit.</p>'
                          '</article></body></html>'),
    (4, "http://h.x/contact", "<html><title>Contact</title><body><p>Call us</p></body></html>"),
]


def test_crawl_rank_extract_validate(spark):
    p = pages_df(spark, SITE)
    crawl = J.crawl_sites(p)
    visited = {r.url: r.depth for r in crawl.visited.collect()}
    assert visited == {"http://h.x/": 0, "http://h.x/adm": 1, "http://h.x/cur": 1, "http://h.x/int": 2}
    doc = json.loads(crawl.documents.collect()[0].json)
    assert doc["crawl_stats"]["total_pages_visited"] == 4
    assert list(doc["relevant_urls"])[0] == "http://h.x/"

    ranked = J.rank_sites(crawl).orderBy("rank").collect()
    assert [(r.url, r.relevance_score) for r in ranked] == [
        ("http://h.x/adm", 2), ("http://h.x/cur", 2), ("http://h.x/int", 1)]

    merged, items, errors = J.extract_records(J.rank_sites(crawl), p)
    assert errors.count() == 0
    rec = MG.assemble([(list(r.path), r.kind, r.value) for r in merged.collect()],
                      [(list(r.path), r.seq, r.idx, r.kind, r.value) for r in items.collect()])
    assert rec["title"] == "Admissions"          # first truthy in ranked order
    assert rec["tags"] == ["interview day"]       # only /adm has anchors
    assert rec["stats"] == {"anchors": 1}
    assert rec["admissions"] == {} and rec["contact"] == {}

    results, summary, issues, report = J.validate_records(merged, items, p)
    s = summary.collect()[0]
    assert s.total_fields == 5 * 4               # title, lang, tags[0], stats.anchors x 5 pages
    byfield = {(r.field_path, r.url): r.is_valid for r in results.collect()}
    assert byfield[("title", "http://h.x/adm")] is True
    assert byfield[("tags[0]", "http://h.x/int")] is False  # 1 of 2 words < 0.75
    assert byfield[("tags[0]", "http://h.x/adm")] is True   # exact: glued page text holds it
    text = report.collect()[0].json
    assert "Detailed Results:" in text and "Validation rate:" in text
    assert issues.where(F.col("issue") == "Missing required field: stats.words").count() == 1


def test_user_extractor_hook(spark):
    import pandas as pd
    from sitelens.operators import records as RC

    def extractor(batches):
        for pdf in batches:
            yield pd.DataFrame({"entity": pdf.entity, "seq": pdf.seq, "source_url": pdf.url,
                                "json": [json.dumps({"section": s, "batch": int(b)})
                                         for s, b in zip(pdf.schema_section, pdf.batch_no)]})

    p = pages_df(spark, SITE).withColumn("rank", F.col("page_id") + 1).withColumn("content", F.lit("x"))
    out = RC.extract_fragments(p, extractor, concurrency=2, schema_section="admissions")
    got = sorted((r.seq, json.loads(r.json)["section"], json.loads(r.json)["batch"]) for r in out.collect())
    assert got == [(1, "admissions", 0), (2, "admissions", 0), (3, "admissions", 0), (4, "admissions", 1),
                   (5, "admissions", 1)]
