"""Embedding whitening on distributed block matrices (operator 13).

Centred rows are indexed into the blocks of an MLlib ``BlockMatrix``; transposed times itself it gives the scatter
matrix, whose eigenvectors are found locally, and a second block product projects the rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.operators.joins import join_small
from stratum.session import checkpoint_root

SCALE = 256
COMPONENTS = 4
ROWS_PER_BLOCK = 4096
BLOCKS_PER_TASK = 4
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
_IN_PARTITION = (1 << 33) - 1


def quantised(v: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry, as longs (what a long cannot hold saturates)."""
    return F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable(v: Column) -> Column:
    """True for vectors without null, NaN or infinite entries; false for null."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(finite, F.lit(False))


def indexed(table: DataFrame) -> DataFrame:
    """``table`` with ``row``: distinct numbers, dense within each task's rows, from 0 on.

    Rows are counted per task; only those counts (one row a task) are summed in one place and broadcast.
    """
    own = table.withColumns({"part": F.spark_partition_id(), "nth": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))}).checkpoint()
    sizes = own.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return own.join(F.broadcast(starts), "part").withColumn("row", F.col("start") + F.col("nth")).drop("part", "nth", "start")


def repeats(rows: DataFrame, x: Column) -> DataFrame:
    """(row) of every row whose vector a smaller row holds too. A common vector is reduced map-side, by its SHA-256."""
    keyed = rows.select("row", F.unhex(F.sha2(x.cast("string").cast("binary"), 256)).alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("row").alias("row")).select("row")
    return keyed.select("row").join(first, "row", "left_anti")


def block_matrix(rows: DataFrame, vector: Column, n_rows: int, dim: int, rows_per_block: int) -> BlockMatrix:
    """Rows as blocks of ``rows_per_block`` x ``dim``; numbers without a row are rows of zeros, or no block at all."""
    table = MLUtils.convertVectorColumnsFromML(rows.select("row", array_to_vector(vector).alias("vector")), "vector")
    return IndexedRowMatrix(table, n_rows, dim).toBlockMatrix(rows_per_block, dim)


def gram(matrix: BlockMatrix, blocks_per_task: int = BLOCKS_PER_TASK) -> np.ndarray:
    """Transpose times the matrix: a local dim x dim array.

    The product has one block, so without a split of the middle dimension all blocks would meet in one task. The
    Python method does not offer that argument of the JVM's ``multiply``, so it is called on the wrapped matrix.
    """
    splits = max(1, math.ceil(matrix.numRowBlocks / blocks_per_task))
    left = matrix.transpose()
    product = left._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def principal(scatter: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, unit eigenvectors as columns, trace) of the covariance; local, dim x dim."""
    v = (scatter + scatter.T) / (2.0 * n)
    values, vectors = np.linalg.eigh(v)
    return values[::-1][:k], vectors[:, ::-1][:, :k], float(np.trace(v))


def deviation(x: Column, sums: list[int], n: int, largest: int) -> Column:
    """Sum over dimensions of (n*x - S)**2, exact: longs where the proven bound allows it, else decimals; null beyond a long."""
    bound = len(sums) * (n * largest + max(map(abs, sums), default=0)) ** 2
    if bound < 1 << 63:
        totals = F.array(*[F.lit(s).cast("long") for s in sums])
        parts = F.zip_with(x, totals, lambda a, s: (F.lit(n).cast("long") * a - s) * (F.lit(n).cast("long") * a - s))
        return F.aggregate(parts, F.lit(0).cast("long"), lambda t, p: t + p)
    wide = "decimal(38,0)"
    if n * largest + max(map(abs, sums)) >= 10 ** 38:
        return F.lit(None).cast("long")
    totals = F.array(*[F.lit(str(s)).cast(wide) for s in sums])
    off = F.zip_with(x, totals, lambda a, s: (F.try_multiply(a.cast("decimal(19,0)"), F.lit(str(n)).cast("decimal(19,0)")).cast(wide) - s).cast(wide))
    square = F.transform(off, lambda o: F.try_multiply(o, o).try_cast(wide))
    total = F.aggregate(square, F.lit(0).cast(wide), lambda t, p: F.try_add(t, p).try_cast(wide))
    return total.try_cast("long")


def whiten(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, rows_per_block: int = ROWS_PER_BLOCK,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    Vectors that are null or hold null, NaN or infinite entries take no part; of the others those of the most
    frequent length do (of equally frequent lengths, the longest). The mean and covariance are those of the
    distinct quantised vectors; every row is projected, repeated vectors and ids as often as they come. A component
    without variance (fewer distinct vectors than dimensions) has ``whitened`` null and does not count in
    ``identity_error``; ``explained`` is null when nothing varies, ``deviation`` when a long cannot hold it. An empty table,
    or one of empty vectors, gives no rows. Other columns are ignored.

    The driver holds dim x dim numbers, the column sums and the blocks' coordinates (one pair per
    ``rows_per_block`` rows, MLlib's own plan of a block product).
    """
    spark = table.sparkSession
    checkpoint_root(spark)
    rows = indexed(table.where(usable(F.col(vector_col))).select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")))
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("rows"), F.max("row").alias("last"))
    top = lengths.orderBy(F.desc("rows"), F.desc("dim")).first()
    if top is None or top["dim"] == 0:
        return spark.createDataFrame([], SCHEMA)
    dim, n_rows = int(top["dim"]), int(top["last"]) + 1
    rows = rows.where(F.size("v") == dim)
    x = quantised(F.col("v"), scale)
    again = repeats(rows, x).checkpoint()
    fit = join_small(rows, again, "row", "left_anti")

    entry = F.col("x").cast("decimal(19,0)")
    sums = fit.select(F.posexplode(x).alias("i", "x")).groupBy("i").agg(
        F.sum(entry).alias("s"), F.max(F.abs(entry)).alias("most"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()  # dim rows
    n, totals, largest = int(sums[0]["n"]), [int(r["s"]) for r in sums], max(int(r["most"]) for r in sums)
    mean = F.array(*[F.lit(s / n) for s in totals])
    centred = F.zip_with(x, mean, lambda a, m: a.cast("double") - m)

    values, vectors, trace = principal(gram(block_matrix(fit, centred, n_rows, dim, rows_per_block)), n, components)
    k = len(values)
    varied = values > max(values[0], 0.0) * dim * np.finfo(float).eps
    whitening = np.where(varied, vectors / np.sqrt(np.where(varied, values, 1.0)), 0.0)
    projected = project(spark, block_matrix(rows, centred, n_rows, dim, rows_per_block), whitening).checkpoint()
    error = identity_error(join_small(projected, again, "row", "left_anti"), np.flatnonzero(varied).tolist())

    slim = rows.select("row", "vec_id", deviation(x, totals, n, largest).alias("deviation"))
    out = slim.join(projected, "row", "left").select(
        "vec_id", "deviation", F.posexplode(F.coalesce("w", F.array_repeat(F.lit(0.0), k))).alias("at", "w"))
    shares = F.array(*[F.lit(float(e) / trace if trace > 0 else None).cast("double") for e in values])
    known = F.array(*[F.lit(bool(v)) for v in varied])
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.get(known, "at"), F.col("w")).alias("whitened"), F.get(shares, "at").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def project(spark: SparkSession, matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """(row, w): the rows times the whitening matrix, which is one small block."""
    dim, k = whitening.shape
    block = Matrices.dense(dim, k, whitening.ravel(order="F").tolist())
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), dim, k, dim, k)
    rows = matrix.multiply(right).toIndexedRowMatrix()
    # as a DataFrame inside the JVM; ``rows.rows`` would pass every row through Python
    table = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return table.select(F.col("index").alias("row"), vector_to_array("vector").alias("w"))


def identity_error(fit: DataFrame, places: list[int]) -> float | None:
    """Largest absolute entry of the whitened fit rows' covariance minus the identity."""
    pairs = [(i, j) for i in places for j in places if i <= j]
    if not pairs:
        return None
    found = fit.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
