"""Embedding whitening on Spark MLlib's ``BlockMatrix``.

Vectors become whole numbers, so that counts and sums are exact and equal vectors are equal. Each distinct
vector once is the fit list. Its rows, centred, are numbered and packed into distributed blocks; the transpose
times the matrix gives the scatter, a local ``eigh`` of this small square the whitening matrix, and a product of
blocks with that matrix the projected rows.

Two things keep ``BlockMatrix.multiply`` even at any number of rows. The scatter is a sum over all blocks for one
small result, so the middle dimension is split into many tasks (else one task would get all blocks). And MLlib deals a
product with one column of blocks to the square root of the tasks only; so the blocks are laid out on a square grid, whose columns
are multiplied by a block diagonal of whitening matrices.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from spendscore.llm.common import removed, written_at
from spendscore.llm.vectors import whole_numbers

#: Largest absolute number, before the offset: sums over 2^32 rows and more are still longs.
MOST = 1 << 30
#: Rows of a block: few enough to be a small part of a task, and more of them before there are more blocks than ``BLOCKS``,
#: whose numbers MLlib keeps on the driver.
LEAST_ROWS, MOST_ROWS, BLOCKS = 2048, 65536, 100_000
#: Bytes of blocks that a task multiplies.
TASK_BYTES = 64 << 20
#: Eigenvalues below this share of the largest, times the dimension, are rounding errors of zero.
ROUNDING = 1e-15

RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"
BLOCK_ID = StructType([StructField("blockRowIndex", LongType()), StructField("blockColIndex", LongType())])
#: A block as MLlib reads and writes it.
BLOCK = StructType([StructField("blockId", BLOCK_ID), StructField("subMatrix", MatrixUDT())])
#: The same as plain columns.
PLAIN = StructType([StructField("blockId", BLOCK_ID), StructField("subMatrix", MatrixUDT.sqlType())])


def numbered(rows: DataFrame) -> DataFrame:
    """Written rows with ``at`` (``monotonically_increasing_id``) as rows with ``number`` from 0 without a gap."""
    part = F.shiftright("at", 33)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # One row per task that wrote, whatever the number of rows.
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", before.alias("start"))
    return (rows.withColumn("part", part).join(starts, "part")
            .withColumn("number", F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "start", "at"))


def _literal(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _blocks(rows: DataFrame, rows_per_block: int, whole: list[int], rest: list[float], extra: list[str], purpose: str) -> str:
    """Rows, centred, in blocks; writes block id, matrix (row by row) and arrays of the ``extra`` columns, and gives the folder."""
    dim = len(whole)
    block = F.floor(F.col("number") / rows_per_block).cast("long")
    shift = F.array(*[F.lit(r) for r in rest])
    packed = rows.withColumn("block", block).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("number", F.zip_with("x", _literal(whole), lambda c, q: c - q).alias("x"), *extra))).alias("rows"))
    centred = F.flatten(F.transform("rows", lambda r: F.zip_with(r["x"], shift, lambda c, s: c.cast("double") - s)))
    matrix = F.struct(
        F.lit(1).cast("byte").alias("type"), F.size("rows").alias("numRows"), F.lit(dim).alias("numCols"),
        F.lit(None).cast("array<int>").alias("colPtrs"), F.lit(None).cast("array<int>").alias("rowIndices"),
        centred.alias("values"), F.lit(True).alias("isTransposed"))
    return written_at(
        packed.select(F.struct("block", F.lit(0).cast("long").alias("column")).alias("blockId"), matrix.alias("subMatrix"),
                      *[F.col("rows")[name].alias(name) for name in extra])
        .select(F.col("blockId").cast("struct<blockRowIndex:bigint,blockColIndex:bigint>").alias("blockId"), "subMatrix", *extra), purpose)[1]


def _matrix(blocks: DataFrame, rows_per_block: int, cols_per_block: int, rows: int, cols: int) -> BlockMatrix:
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, rows_per_block, cols_per_block, rows, cols), rows_per_block, cols_per_block)


def _scatter(path: str, spark: SparkSession, rows_per_block: int, rows: int, cols: int, tasks: int) -> np.ndarray:
    """The transpose times the matrix of the written blocks, the middle dimension split into ``tasks``."""
    tall = _matrix(spark.read.schema(BLOCK).parquet(path), rows_per_block, cols, rows, cols)
    product = tall.transpose()._java_matrix_wrapper.call("multiply", tall._java_matrix_wrapper._java_model, tasks)
    return BlockMatrix(product, cols, cols).toLocalMatrix().toArray()


def _projected(path: str, spark: SparkSession, matrix: np.ndarray, rows_per_block: int, rows: int, tasks: int, purpose: str) -> str:
    """Written blocks times ``matrix``, written with their first block ids; gives the folder."""
    dim, kept = matrix.shape
    blocks = -(-rows // rows_per_block)
    side = math.isqrt(blocks - 1) + 1
    row = F.col("blockId.blockRowIndex")
    place = F.struct(F.floor(row / side).cast("long").alias("blockRowIndex"), (row % side).alias("blockColIndex"))
    grid = _matrix(spark.read.schema(BLOCK).parquet(path).select(place.alias("blockId"), "subMatrix"),
                   rows_per_block, dim, side * rows_per_block, side * dim)
    values = matrix.ravel(order="F").tolist()
    context = spark.sparkContext
    diagonal = context.range(side, numSlices=tasks).map(lambda k: ((k, k), Matrices.dense(dim, kept, values)))
    product = grid.multiply(BlockMatrix(diagonal, dim, kept, side * dim, side * kept))
    found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    back = F.struct((F.col("_1._1").cast("long") * side + F.col("_1._2")).alias("blockRowIndex"), F.lit(0).cast("long").alias("blockColIndex"))
    return written_at(found.select(back.alias("blockId"), F.col("_2").alias("subMatrix")), purpose)[1]


def whitened(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
    offset: int = 1_000_000,
    components: int = 16,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Per row and component: ``id_col``, component, n, deviation, whitened, explained, identity_error.

    Components c become ``x = floor(scale * c) + offset``. The fit list is each distinct x vector once: n of them, with sums S.
    Component k is the unit eigenvector of the k-th largest eigenvalue e of the covariance of the fit list (divisor n), its
    largest entry positive; ``whitened`` is (x - S/n) on it, over sqrt(e). ``deviation`` is the sum of (n*x - S)^2, exact, NULL if
    it is no long; ``explained`` e over the trace; ``identity_error`` the largest absolute entry of the whitened fit list's covariance minus the identity.

    * Rows with a NULL or empty vector or NULL or non-finite components are dropped, as are rows of another than the
      most frequent length or with ``scale * c`` beyond 2^30. NULL and repeated ids stay as they are, a row each.
    * A component whose eigenvalue is zero but for rounding (fewer distinct vectors than components, say) has ``whitened`` NULL and
      is left out of ``identity_error``; without any component left ``identity_error`` is NULL, without variance ``explained`` too.
    * Ties of eigenvalues are in the order of ``eigh``. There are ``min(components, dimension)`` rows for each vector.
    * An empty table gives no rows; extra columns, whatever their names, are not looked at.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    usable, dim, _ = whole_numbers(source, "vector", scale, "x", MOST, offset)
    if not dim:
        return spark.createDataFrame([], f"`{id_col}` long, {RESULT}")
    rows, rows_at = written_at(usable.select("id", "x").withColumn("at", F.monotonically_increasing_id()), "vectors")
    fit, fit_at = written_at(rows.select("x").distinct().withColumn("at", F.monotonically_increasing_id()), "fit-list")
    total, *_ = fit.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[j]).alias(f"s{j}") for j in range(dim)]).collect()
    n, sums = total[0], [*total[1:]]
    number = rows.count()

    # x - S/n as (x - q) - r/n, with whole q and 0 <= r < n: exact but for the last difference.
    whole, rest = [s // n for s in sums], [s % n for s in sums]
    share = [r / n for r in rest]
    size = rows_per_block or min(MOST_ROWS, max(LEAST_ROWS, -(-number // BLOCKS)))
    tasks = lambda count: max(1, -(-count * dim * 8 // TASK_BYTES))
    fit_blocks = _blocks(numbered(fit), size, whole, share, [], "fit-blocks")
    scatter = _scatter(fit_blocks, spark, size, n, dim, max(tasks(n), min(spark.sparkContext.defaultParallelism, -(-n // size))))
    values, axes = np.linalg.eigh((scatter + scatter.T) / 2 / n)
    kept = min(components, dim)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(dim)] < 0, -1.0, 1.0)
    sound = values[:kept] > max(values[0], 0.0) * dim * ROUNDING
    whitening = np.where(sound, axes[:, :kept] / np.sqrt(np.where(sound, values[:kept], 1.0)), 0.0)

    projected_fit = _projected(fit_blocks, spark, whitening, size, n, tasks(n), "whitened-fit")
    again = _scatter(projected_fit, spark, size, n, kept, max(1, tasks(n) * kept // dim))[np.ix_(sound, sound)] / n
    error = float(np.abs(again - np.eye(len(again))).max()) if sound.any() else None

    deviation = F.aggregate(
        F.zip_with("x", F.arrays_zip(_literal(whole).alias("q"), _literal(rest).alias("r")),
                   lambda c, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), c - s["q"]), s["r"])),
        F.lit(0).cast("long"), lambda done, d: F.try_add(done, F.try_multiply(d, d)))
    row_blocks = _blocks(numbered(rows.withColumn("deviation", deviation)), size, whole, share, ["id", "deviation"], "row-blocks")
    projected = _projected(row_blocks, spark, whitening, size, number, tasks(number), "whitened-rows")

    named = spark.read.schema(StructType([PLAIN["blockId"]]).add("id", ArrayType(LongType())).add("deviation", ArrayType(LongType()))).parquet(row_blocks)
    found = spark.read.schema(PLAIN).parquet(projected)
    trace = float(values.sum())
    parts = F.explode(F.array(*[
        F.struct(F.lit(k + 1).alias("component"), F.lit(bool(sound[k])).alias("sound"),
                 F.lit(float(values[k]) / trace if trace > 0 else None).cast("double").alias("explained"), F.lit(k).alias("k")) for k in range(kept)]))
    value = F.col("values")[F.when(F.col("by_row"), F.col("row") * kept + F.col("part.k")).otherwise(F.col("part.k") * F.col("height") + F.col("row"))]
    out = (
        named.join(found, "blockId")
        .select(F.posexplode(F.arrays_zip("id", "deviation")).alias("row", "of"), F.col("subMatrix.values").alias("values"),
                F.col("subMatrix.numRows").alias("height"), F.col("subMatrix.isTransposed").alias("by_row"))
        .select("row", "of", "values", "height", "by_row", parts.alias("part"))
        .select(F.col("of.id").alias(id_col), "part.component", F.lit(n).cast("long").alias("n"), "of.deviation",
                F.when(F.col("part.sound"), value).alias("whitened"), "part.explained", F.lit(error).cast("double").alias("identity_error"))
    )
    result, _ = written_at(out, "whitened")
    removed(spark, rows_at, fit_at, fit_blocks, projected_fit, row_blocks, projected)
    return result
