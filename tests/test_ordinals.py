import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitelens.operators.ordinals import ordinal_within


def test_ordinal_matches_row_number_on_skewed_groups(spark):
    rng = random.Random(1)
    rows = [("hot", rng.randint(0, 50), i) for i in range(3000)] + \
           [(f"g{i % 7}", rng.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, seq int, idx int")
    got = {(r.k, r.seq, r.idx): r.pos for r in ordinal_within(df, ["k"], ["seq", "idx"], partitions=8).collect()}
    w = Window.partitionBy("k").orderBy("seq", "idx")
    want = {(r.k, r.seq, r.idx): r.pos for r in df.withColumn("pos", F.row_number().over(w) - 1).collect()}
    assert got == want
