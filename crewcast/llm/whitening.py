"""Whitening of integer vectors with MLlib's BlockMatrix.

1. Sums of every dimension are exact integers; a row's deviation from the mean is (n * x - sum) / n.
2. Centred rows, numbered from 0, become blocks of rows. The transpose times the matrix is the scatter matrix: products of
   one block each, in many tasks, summed pairwise.
3. The scatter is as small as a vector is long; its eigenvectors are found on the driver.
4. The blocks times the whitening matrix are the whitened rows, whose covariance is measured by the same product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from crewcast.llm.storage import numbered, stored
from crewcast.llm.vectors import matrix, usable

#: Rows of a block, and the most blocks that one task multiplies.
BLOCK_ROWS = 4_096
TASK_BLOCKS = 8
#: Widest block.
BLOCK_COLUMNS = 1_024
SCHEMA = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def sums(rows: DataFrame) -> list[int]:
    """Exact sums of every dimension of ``vector``, added up per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [matrix(b.column(0), np.int64).sum(0) for b in batches if b.num_rows]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(parts, 0).tolist()], pa.list_(pa.int64()))], ["total"])

    parts = rows.select("vector").mapInArrow(run, "total array<long>").select(F.posexplode("total").alias("at", "value"))
    found = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()  # one row a dimension
    return [int(r["total"]) for r in sorted(found, key=lambda r: r["at"])]


def blocks(rows: DataFrame, columns: int) -> BlockMatrix:
    """Distributed blocks of ``centred`` arrays at their ``index``, computed once."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("centred").alias("centred")), "centred")
    return IndexedRowMatrix(vectors).toBlockMatrix(BLOCK_ROWS, min(columns, BLOCK_COLUMNS)).persist(StorageLevel.MEMORY_AND_DISK)


def scatter(centred: BlockMatrix, rows: int) -> np.ndarray:
    """Transpose times matrix. The rows between are split so that no task multiplies more than TASK_BLOCKS blocks.

    That split is an argument of the JVM's ``multiply`` which the Python method does not pass on.
    """
    splits = max(1, -(-rows // (BLOCK_ROWS * TASK_BLOCKS)))
    turned = centred.transpose()
    product = turned._java_matrix_wrapper.call("multiply", centred._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, centred.colsPerBlock).toLocalMatrix().toArray()


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) by falling eigenvalue, without those that are zero but for rounding.

    An eigenvector's largest entry is positive.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(most, int((values > max(values[0], 0) * len(values) * 1e-13).sum()))
    values, vectors = values[:count], vectors[:, :count]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(count)] if count else np.zeros(0)
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


def _release(held: BlockMatrix) -> None:
    held._java_matrix_wrapper._java_model.blocks().unpersist(False)


def _projected(spark: SparkSession, centred: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """(index, whitened) rows of the blocks times ``weights``."""
    wide = centred.colsPerBlock
    parts = [((i, 0), Matrices.dense(*weights[b : b + wide].shape, weights[b : b + wide].ravel("F").tolist()))
             for i, b in enumerate(range(0, len(weights), wide))]
    product = centred.multiply(BlockMatrix(spark.sparkContext.parallelize(parts, 1), wide, weights.shape[1], *weights.shape))
    lines = product.toIndexedRowMatrix().rows.map(lambda r: (int(r.index), r.vector.toArray().tolist()))
    return spark.createDataFrame(lines, "index long, whitened array<double>")


def whiten(rows: DataFrame, most: int = 8, id_col: str = "vec_id", vector_col: str = "embedding",
           entry: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained, identity_error.

    ``entry`` makes a whole number of a vector's entry. ``deviation`` is the sum of (n * x - sum)^2, null where it exceeds
    a long. A component whose eigenvalue is zero but for rounding cannot be whitened and is left out, so equal rows,
    a single row and an empty table give no rows. Vectors that are not complete (see :func:`vectors.usable`) take no part; rows
    with a null id do, and repeated rows each. Other columns are not looked at. Entries too large for n * x to fit
    a long raise ValueError.
    """
    spark = rows.sparkSession
    base = numbered(usable(rows, vector_col, id=rows[id_col].cast("long")).withColumn("vector", F.transform("vector", lambda c: entry(c.cast("double")).cast("long"))))
    facts = base.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    n = facts["n"]
    if not n:
        return spark.createDataFrame([], SCHEMA)
    if n * facts["most"] >= 2.0**61:
        raise ValueError(f"sums of {n} entries up to {facts['most']:.0f} do not fit a long")
    total = sums(base)
    totals = F.array(*[F.lit(s).cast("long") for s in total])
    away = base.withColumn("away", F.zip_with("vector", totals, lambda x, s: F.lit(n).cast("long") * x - s))
    centred = away.withColumn("centred", F.transform("away", lambda a: a / F.lit(float(n))))
    held = blocks(centred, len(total))
    covariance = scatter(held, n) / n
    values, vectors = components(covariance, most)
    if not len(values):
        _release(held)
        return spark.createDataFrame([], SCHEMA)
    whitened = stored(_projected(spark, held, vectors / np.sqrt(values)))
    _release(held)

    middle = whitened.agg(*[F.avg(F.get("whitened", F.lit(i))).alias(f"m{i}") for i in range(len(values))]).first()
    around = F.array(*[F.lit(float(m)) for m in middle])
    again = blocks(whitened.withColumn("centred", F.zip_with("whitened", around, lambda z, m: z - m)), len(values))
    error = float(np.abs(scatter(again, n) / n - np.eye(len(values))).max())
    _release(again)

    square = lambda a: a.cast("decimal(19,0)") * a.cast("decimal(19,0)")
    exact = F.aggregate("away", F.lit(0).cast("decimal(38,0)"), lambda t, a: (t + square(a)).cast("decimal(38,0)"))
    deviation = F.when(exact <= F.lit(2**63 - 1).cast("decimal(38,0)"), exact.cast("long"))
    share = F.array(*[F.lit(float(v / np.trace(covariance))) for v in values])
    out = away.select("index", "id", deviation.alias("deviation")).join(whitened, "index")
    return out.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
