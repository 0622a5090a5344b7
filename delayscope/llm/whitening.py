"""Embedding whitening with MLlib's distributed block matrices.

The rows are centred, indexed and cut into blocks; the transpose times the matrix gives the
scatter, whose small eigenproblem is solved on the driver; the block matrix times the
whitening matrix projects all rows. What goes through the driver has the size of one
vector's square, however many rows there are.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delayscope.llm.common import stored
from delayscope.llm.vectors import sound

#: Rows of a block; blocks of more rows are used past BLOCKS of them, as the driver knows each.
BLOCK_ROWS, BLOCKS = 2048, 1 << 16
#: Eigenvalues below this part of the largest are zero but for rounding: no component.
RANK = 1e-12


def indexed(rows: DataFrame) -> DataFrame:
    """The rows of a stored table with ``index``, from 0 without gaps.

    A row's place in its partition is written down first, so that a partition that is
    read again cannot be numbered otherwise; the sizes of the partitions before are added.
    """
    local = F.monotonically_increasing_id()
    placed = stored(rows.select("*", F.shiftright(local, 33).cast("int").alias("part"), local.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "placed-vectors")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # One row per partition of the input.
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    return placed.join(F.broadcast(before), "part").withColumn("index", F.col("before") + F.col("place")).drop("part", "place", "before", "size")


def totals(rows: DataFrame, vector: str, d: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of every component, one row from each task."""
    sums = (F.sum(F.get(vector, F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(d))
    found = rows.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    return found["n"], [int(v or 0) for v in found[1:]]


def block_matrix(vectors: DataFrame, n: int, d: int) -> BlockMatrix:
    """The distributed matrix of (index long, vector array<double>)."""
    dense = vectors.select("index", array_to_vector("vector").alias("vector"))
    rows = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(dense, "vector"), n, d)
    return rows.toBlockMatrix(max(BLOCK_ROWS, -(-n // BLOCKS)), d)


def gram(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, its middle dimension spread over as many tasks as there are blocks (in thousands a few)."""
    java, splits = matrix._java_matrix_wrapper._java_model, min(max(matrix.numRowBlocks, 1), 4096)
    # The public Scala method; the Python one has no argument for the splits.
    product = BlockMatrix(java.transpose().multiply(java, splits), matrix.colsPerBlock, matrix.colsPerBlock)
    return product.toLocalMatrix().toArray()


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """(index, vector) of a block matrix."""
    found = callMLlibFunc("getIndexedRows", matrix._java_matrix_wrapper._java_model.toIndexedRowMatrix())
    return found.select("index", vector_to_array("vector").alias("vector"))


def times(spark: SparkSession, matrix: BlockMatrix, right: np.ndarray) -> BlockMatrix:
    """The block matrix times a small local one."""
    d, k = right.shape
    block = DenseMatrix(d, k, right.ravel(order="F").tolist())
    return matrix.multiply(BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), d, k))


def _literals(values, kind: str) -> Column:
    """A constant array, as one text literal: a literal of many elements is slow to plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding", scale: int = 64, offset: int = 1_000_000, components: int = 32) -> DataFrame:
    """Every vector in the leading principal components, each scaled to unit variance.

    Entries c become whole numbers x = floor(scale * c) + offset. The fit is over all rows:
    their number n, exact sums S and the covariance V of x with divisor n, centred before
    it is multiplied. Components are V's unit eigenvectors by falling eigenvalue e, their
    sign chosen so that the entry of largest size is positive. Returns vec_id, component
    (from 1), n, deviation (sum of (n x - S)^2 over the entries, exact), whitened
    ((x - S/n) on the component, over the root of e), explained (e / trace V) and
    identity_error, the largest entry of the covariance of whitened less the identity.

    Vectors that are null or hold a null or non-finite entry take no part, nor do those of
    another than the most common length. Components whose eigenvalue is zero but for
    rounding have no direction of their own and are left out; so is everything where all
    vectors are alike. Repeated rows and ids, null ids too, are rows of their own. Entries
    are held within 53 bits. An empty table gives an empty result; other columns are not
    read, whatever they are called.
    """
    spark = vectors.sparkSession
    limit = float(2**52)
    entry = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-limit)), F.lit(limit))).cast("long") + offset)
    slim = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    table = stored(indexed(sound(slim, "v").select("vec_id", entry.alias("x"))), "whole-vectors")
    head = table.select(F.size("x").alias("d")).first()
    if head is None:
        return spark.createDataFrame([], WHITENED)
    d = head["d"]
    n, sums = totals(table, "x", d)
    # x - S / n, and n x - S, from the whole part of the mean and the rest.
    whole, part = zip(*(divmod(s, n) for s in sums))
    centred = F.zip_with(F.zip_with("x", _literals(whole, "bigint"), lambda x, m: x - m), _literals(part, "bigint"), lambda x, r: x - r / F.lit(float(n)))
    scaled = F.zip_with(F.zip_with("x", _literals(whole, "bigint"), lambda x, m: x - m), _literals(part, "bigint"), lambda x, r: x.cast("decimal(18,0)") * F.lit(n).cast("decimal(18,0)") - r)
    deviation = F.aggregate(scaled, F.lit(0).cast("decimal(38,0)"), lambda total, v: (total + v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast("decimal(38,0)"))
    rows = stored(table.select("index", "vec_id", deviation.alias("deviation"), centred.alias("vector")), "centred-vectors")

    matrix = block_matrix(rows.select("index", "vector"), n, d)
    covariance = gram(matrix) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    values, directions = values[::-1], directions[:, ::-1]
    trace = float(np.trace(covariance))
    k = int(min(components, (values > RANK * max(values[0], 0)).sum())) if values[0] > 0 else 0
    if not k:
        return spark.createDataFrame([], WHITENED)
    directions = directions[:, :k] * np.sign(directions[np.abs(directions[:, :k]).argmax(axis=0), np.arange(k)])
    projected = times(spark, matrix, directions / np.sqrt(values[:k]))
    found = stored(rows_of(projected), "whitened-vectors")
    means = found.agg(*(F.avg(F.get("vector", F.lit(i))).alias(f"m{i}") for i in range(k))).first()
    means = np.array([float(m) for m in means])
    spread = gram(projected) / n - np.outer(means, means)
    error = float(np.abs(spread - np.eye(k)).max())
    explained = _literals((values[:k] / trace).tolist(), "double")
    return found.join(rows.select("index", "vec_id", "deviation"), "index").select(
        "vec_id", "deviation", F.posexplode(F.arrays_zip(F.col("vector").alias("whitened"), explained.alias("explained"))).alias("i", "c")
    ).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "c.whitened", "c.explained", F.lit(error).alias("identity_error"),
    )
