"""Reading, writing and row-identity helpers shared by the operators."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.session import prepare, scratch_dir

TOKENIZER_PACKAGE = "public_tokenizers"
_recording: list[str] | None = None
_left_behind: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: the plan is cut there, and a lost executor rereads the files."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    if _recording is not None:
        _recording.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage(fn):
    """A pipeline stage: drops the tables that the stage before it left in the
    shared folder, whose result has been stored by now, and remembers its own."""
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _recording, _left_behind
        prepare(spark)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        while _left_behind:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_left_behind.pop())
            path.getFileSystem(conf).delete(path, True)
        _recording = []
        try:
            return fn(spark, docs, sf_dir)
        finally:
            _left_behind, _recording = _recording, None
    return run


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """The row as one struct, so that none of its names meets one of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas in it use it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def slots(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import importlib
    return importlib.import_module(TOKENIZER_PACKAGE).path(name)
