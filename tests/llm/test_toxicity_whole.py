"""Voters and lexicon look at whole texts and at all terms."""

import random

from pyspark.sql import functions as F

from sitelens.llm import toxicity as T


def test_shouting_after_a_long_opening_counts():
    model = T.Model()
    for opening in ("1234567890 " * 300, "- " * 1500, "ЖШ" * 1200):
        assert model.profile(opening + "SHOUTED WORDS " * 4)[1][0] == 1.0
        assert model.profile(opening + "shouted words " * 4)[1][0] == 0.0


def test_copies_of_a_long_text_leave_room_for_other_terms(spark):
    rnd = random.Random(6)
    plain = ["".join(rnd.choices("bdfgklmnoaeiu", k=5)) for _ in range(200)]
    long = " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(7000))
    rows = [(1, f"{long} end") for _ in range(30)]
    for _ in range(14):
        words = rnd.choices(plain, k=20)
        words.insert(rnd.randrange(20), "vilko")
        rows.append((1, " ".join(words)))
    rows += [(0, " ".join(rnd.choices(plain, k=25))) for _ in range(120)]
    sample = spark.createDataFrame([(i, t, y) for i, (y, t) in enumerate(rows)], "doc_id bigint, text string, toxic int")
    terms = T.learn_lexicon(sample.repartition(4))
    assert terms[0] in ("=vilko", "vilk")


def test_terms_column(spark):
    words = ["", "abc", "abcd", "abcde", "abcdef", "abcdefg", "übergrößé", "🙂🙂🙂🙂🙂🙂🙂"]
    df = spark.createDataFrame([(w,) for w in words], "word string").select("word", T._terms_column("word").alias("t"))
    assert {r.word: r.t for r in df.collect()} == {w: T._terms_of(w) for w in words}
    assert df.where(F.exists("t", lambda t: t.isNull())).count() == 0
