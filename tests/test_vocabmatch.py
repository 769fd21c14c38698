from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.functions import html as H
from sitelens.operators import sections as SC
from sitelens.operators import vocabmatch as VM
from sitelens.sources.tables import pages as read_pages


def test_large_vocab_path_equals_native_expressions(spark):
    p = read_pages(spark, "/root/testdata/sf0.001").select(
        "entity", "page_id", H.region_text(F.col("html")).alias("content"))
    for secs in (vocab.TEST_SECTION_KEYWORDS, vocab.SECTION_KEYWORDS):
        native = {tuple(r) for r in SC.page_sections(p, sections=secs).collect()}
        large = {tuple(r) for r in VM.page_sections_large(p, "content", VM.vocab_table(spark, secs)).collect()}
        assert native == large


def test_thousands_of_terms_of_any_length(spark):
    import random
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abcé ", k=rnd.randrange(1, 9))) for _ in range(3000)]
    texts = ["".join(rnd.choices("abcé ", k=rnd.randrange(0, 200))) for _ in range(30)] + [None, "ABC"]
    p = spark.createDataFrame([("e", i, t) for i, t in enumerate(texts)], "entity string, page_id bigint, content string")
    got = {(r.page_id, r.keyword) for r in VM.matched_terms(p, "content", VM.vocab_table(spark, {"s": words})).collect()}
    assert got == {(i, w) for i, t in enumerate(texts) if t for w in set(words) if w in t.lower()}


def test_only_candidate_runs_leave_a_task(spark):
    """Runs no keyword is filed under are dropped before the join, keywords of every length are found."""
    texts = spark.createDataFrame([("s", 1, "x y \U0001F600z " + "abcdefghij " * 500), ("s", 2, ""), (None, 3, "gpa"), ("t", 4, "gp")],
                                  "entity string, page_id long, low string")
    vocab = spark.createDataFrame([("a", 0, "gpa"), ("a", 0, "\U0001F600z"), ("b", 1, "y"), ("b", 1, "cdefgh")],
                                  "section string, section_ord int, keyword string")
    filed = vocab.selectExpr("keyword", "substring(keyword, 1, 4) AS run")
    runs = VM._asked_runs(texts, VM._filter(filed))
    assert {(r.page_id, r.run) for r in runs.collect()} == {(1, "\U0001F600z"), (1, "y"), (1, "cdef"), (3, "gpa")}
    found = VM.matched_terms(texts.withColumnRenamed("low", "text"), "text", vocab)
    assert {(r.page_id, r.keyword) for r in found.collect()} == {(1, "\U0001F600z"), (1, "y"), (1, "cdefgh")}
