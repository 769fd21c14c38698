"""Embedding whitening with MLlib's BlockMatrix.

1. Rows with finite vectors are packed, partition by partition and without a
   shuffle, into blocks of ``BLOCK_ROWS`` rows and stored; the number of rows and
   the sums per dimension are exact integers.
2. The blocks, centred before anything is multiplied, are the row blocks of a
   BlockMatrix A.  The scatter is A' A.  Its middle dimension is split, so that the
   blocks of A meet in many tasks and only their d x d products are added up.
3. ``numpy.linalg.eigh`` of the d x d covariance gives the whitening matrix W, and
   A W projects the rows.  The covariance of the projection is computed as in 2.

A BlockMatrix product holds its blocks' places on the driver and a square root of
its partitions' number of output partitions, so a matrix has at most
``PANEL_BLOCKS`` blocks; a longer table is several panels, whose scatters are added.
Only d x d matrices and the panels' block places reach the driver.

Defined cases: rows whose vector is null or holds a null or non-finite entry are
dropped; of the rest those count whose length is the most frequent one (of equally
frequent ones the longest).  An entry's integer is held within 2**40.  Repeated rows
and ids, and null ids, are rows in their own right.  Components whose eigenvalue
is zero to double precision have no whitened value and are not returned, so equal
or too few rows give fewer components; an empty table gives an empty result.
Equal eigenvalues leave the choice of their eigenvectors open.  Other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, slots

SCALE, SHIFT, WIDEST = 64, 1_000_000, float(1 << 40)
BLOCK_ROWS, PANEL_BLOCKS = 512, 16_384
#: Row blocks that one task of the scatter multiplies.
BLOCKS_PER_SPLIT = 64

PACKED = "part int, k int, size int, ids array<bigint>, x binary"


def finite_rows(table: DataFrame) -> DataFrame:
    """``vec_id, x``: the vectors to fit and project, as integers."""
    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                        F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0

    def whole(c):
        return F.floor(F.greatest(F.least(c * SCALE, F.lit(WIDEST)), F.lit(-WIDEST))).cast("bigint") + SHIFT
    return rows.where(F.size("v") == d).select("vec_id", F.transform("v", whole).alias("x"))


def totals(rows: DataFrame) -> tuple[int, list[int], bool]:
    """The number of rows, their sums per dimension, and if n * x - S may leave 62 bits."""
    sums = (rows.select(F.posexplode("x").alias("i", "c")).groupBy("i")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("s"),
                 F.max(F.abs("c")).alias("far")).orderBy("i").collect())
    n = sums[0]["n"] if sums else 0
    return n, [int(r["s"]) for r in sums], any(2 * n * r["far"] >= 1 << 62 for r in sums)


def pack(block_rows: int):
    """A partition's rows in blocks, numbered from 0."""
    def run(batches):
        import pandas as pd
        from pyspark import TaskContext
        part, k, ids, held = TaskContext.get().partitionId(), 0, [], []

        def block():
            code = np.array(held, np.int64).tobytes()
            return pd.DataFrame([(part, k, len(ids), list(ids), code)], columns=["part", "k", "size", "ids", "x"])
        for batch in batches:
            for vec_id, x in zip(batch["vec_id"].astype(object), batch["x"], strict=True):
                ids.append(None if vec_id is None or vec_id != vec_id else int(vec_id))
                held.append(x)
                if len(ids) == block_rows:
                    yield block()
                    k, ids, held = k + 1, [], []
        if ids:
            yield block()
    return run


def numbered(blocks: DataFrame, panel_blocks: int) -> DataFrame:
    """Blocks with their place: ``panel, row`` (in the panel)."""
    from pyspark.sql import Window
    parts = blocks.groupBy("part").agg(F.max("k").alias("last"))     # a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("base"))
    place = F.col("base") + F.col("k")
    return blocks.join(bases, "part").select(
        F.floor(place / panel_blocks).cast("int").alias("panel"), F.pmod(place, F.lit(panel_blocks)).cast("int").alias("row"),
        "size", "ids", "x")


def padded(values: np.ndarray, height: int) -> np.ndarray:
    """Zero rows up to a block's height; they add nothing to a product."""
    return np.concatenate([values, np.zeros((height - len(values), values.shape[1]))])


def matrix(blocks: DataFrame, column: str, centre, width: int, height: int):
    """The BlockMatrix of a panel; ``centre`` makes a block's rows of its stored bytes."""
    from pyspark import StorageLevel
    from pyspark.mllib.linalg import DenseMatrix
    from pyspark.mllib.linalg.distributed import BlockMatrix

    def block(row):
        values = padded(centre(row[column], row["size"]), height)
        return (row["row"], 0), DenseMatrix(height, width, values.ravel(order="F"))
    built = BlockMatrix(blocks.select("row", "size", column).rdd.map(block), height, width)
    return built.persist(StorageLevel.MEMORY_AND_DISK)


def times(left, right, splits: int = 1):
    """``left`` by ``right``, the middle dimension in ``splits`` parts."""
    from pyspark.mllib.linalg.distributed import BlockMatrix
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def scatter(blocks: DataFrame, column: str, centre, width: int, height: int) -> np.ndarray:
    """A' A over all panels, A being the centred rows."""
    total = np.zeros((width, width))
    for panel, n in panels(blocks):
        a = matrix(blocks.where(F.col("panel") == panel), column, centre, width, height)
        splits = max(1, -(-n // BLOCKS_PER_SPLIT), min(n, slots(blocks.sparkSession)))
        total += times(a.transpose(), a, splits).toLocalMatrix().toArray()
        a._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return total


def panels(blocks: DataFrame) -> list[tuple[int, int]]:
    found = blocks.groupBy("panel").agg((F.max("row") + 1).alias("n")).orderBy("panel").collect()
    return [(r["panel"], r["n"]) for r in found]


def project(blocks: DataFrame, centre, weights: np.ndarray, height: int) -> DataFrame:
    """A W: ``panel, row, y``, the projected rows of a block as bytes, stored."""
    from pyspark.mllib.linalg import DenseMatrix
    from pyspark.mllib.linalg.distributed import BlockMatrix
    spark, (d, width) = blocks.sparkSession, weights.shape
    w = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, width, weights.ravel(order="F")))], 1), d, width)
    out = None
    for panel, _ in panels(blocks):
        a = matrix(blocks.where(F.col("panel") == panel), "x", centre, d, height)

        def rows(entry, panel=panel):
            (row, _), block = entry
            return panel, row, bytearray(np.ascontiguousarray(block.toArray()).tobytes())
        made = materialize(spark.createDataFrame(times(a, w).blocks.map(rows), "panel int, row int, y binary"), "white-panel")
        a._java_matrix_wrapper._java_model.blocks().unpersist(False)
        out = made if out is None else out.unionByName(made)
    return out


def column_sums(blocks: DataFrame, width: int) -> np.ndarray:
    """Sums of the projected rows, added up per partition and then on the driver."""
    def add(batches):
        import pandas as pd
        total = np.zeros(width)
        for batch in batches:
            for y in batch["y"]:
                total += np.frombuffer(y).reshape(-1, width).sum(axis=0)
        yield pd.DataFrame({"i": range(width), "s": total})
    sums = blocks.select("y").mapInPandas(add, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return np.array([r["s"] for r in sorted(sums)])


def offsets(code: bytes, size: int, n: int, sums: list[int], wide: bool) -> np.ndarray:
    """n * x - S of a block's rows, exactly: as Python's integers if they are ``wide``."""
    kind = object if wide else np.int64
    return n * np.frombuffer(code, np.int64).reshape(size, len(sums)).astype(kind) - np.array(sums, kind)


def deviations(away: np.ndarray) -> list[int]:
    """Sum over the dimensions of the squares, for each row, exactly."""
    far = int(np.abs(away).max(initial=0))
    if far * far * away.shape[1] >= 1 << 63:
        away = away.astype(object)
    return [int(v) for v in (away ** 2).sum(axis=1)]


def whiten(table: DataFrame, components: int = 32, block_rows: int = BLOCK_ROWS,
           panel_blocks: int = PANEL_BLOCKS) -> DataFrame:
    """``vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error``
    of ``table(vec_id, embedding)``, one row a vector and component."""
    spark = table.sparkSession
    schema = ("vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    rows = finite_rows(table)
    n, sums, far = totals(rows)
    if not n:
        return spark.createDataFrame([], schema)
    d = len(sums)
    blocks = materialize(rows.mapInPandas(pack(block_rows), PACKED), "white-packed")
    blocks = materialize(numbered(blocks, panel_blocks), "white-blocks")

    def centred(code, size):
        return offsets(code, size, n, sums, far).astype(float) / n

    covariance = scatter(blocks, "x", centred, d, block_rows) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    width = min(components, int((values > max(values[0], 0.0) * d * np.finfo(float).eps).sum()))
    if not width:
        return spark.createDataFrame([], schema)
    projected = project(blocks, centred, vectors[:, :width] / np.sqrt(values[:width]), block_rows)
    pairs = materialize(blocks.join(projected, ["panel", "row"]), "white-rows")
    means = column_sums(pairs, width) / n
    covered = scatter(pairs, "y", lambda code, size: np.frombuffer(code).reshape(-1, width)[:size] - means,
                      width, block_rows) / n
    error = float(np.abs(covered - np.eye(width)).max())

    def unpack(batches):
        from decimal import Decimal

        import pandas as pd
        for batch in batches:
            for size, ids, x, y in zip(batch["size"], batch["ids"], batch["x"], batch["y"], strict=True):
                squares = deviations(offsets(x, size, n, sums, far))
                yield pd.DataFrame({"vec_id": pd.array([None if i is None or i != i else int(i) for i in ids], "Int64"),
                                    "deviation": [Decimal(v) for v in squares],
                                    "y": list(np.frombuffer(y).reshape(-1, width)[:size])})
    wide = pairs.select("size", "ids", "x", "y").mapInPandas(unpack, "vec_id bigint, deviation decimal(38,0), y array<double>")
    explained = F.array(*[F.lit(float(e / values.sum())) for e in values[:width]])
    return (wide.select("vec_id", "deviation", F.posexplode("y").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
                    "whitened", F.get(explained, F.col("i")).alias("explained"), F.lit(error).alias("identity_error")))
