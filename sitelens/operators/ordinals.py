"""Row numbers within groups without putting a group into one task.

``row_number() over (partition by k order by o)`` sorts each group in a
single task.  For groups that may hold a third of the data, ``ordinal_within``
range-partitions on (k, o) so a hot group spans several balanced splits,
ranks rows inside each split, and adds the count of the group's rows in
earlier splits (a window over one small row per (split, group)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordinal_within(df: DataFrame, keys: list[str], order: list[str], name: str = "pos",
                   partitions: int | None = None) -> DataFrame:
    """Adds ``name``: 0-based position of each row within its ``keys`` group by
    ``order`` (a total order within the group)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    from sitelens.session import cut_lineage
    # split ids come from a sampled range partitioning: fix them once (both
    # branches below must see the same assignment)
    r = df.repartitionByRange(n, *keys, *order).withColumn("_split", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("_split", *keys).orderBy(*order)) - 1
    r = cut_lineage(r.withColumn("_local", local))
    counts = r.groupBy("_split", *keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    out = r.join(offsets, ["_split", *keys]).withColumn(name, F.col("_off") + F.col("_local"))
    return out.drop("_split", "_local", "_off")
