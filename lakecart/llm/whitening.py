"""Embedding whitening with MLlib block matrices (dealt operator 11).

Centred rows get gapless indices and become a `BlockMatrix`; its transpose times itself is the scatter matrix, whose
eigenvectors (`eigh` on the driver, dimensions squared) give the whitening matrix; a second block multiplication
projects every row.  Rows stay in the JVM and move as blocks.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.llm.store import written

# Rows of a block: at least, and at most; between them blocks grow with the table so that their number, which MLlib
# plans on the driver, stays near BLOCKS.
BLOCK_ROWS, MAX_BLOCK_ROWS, BLOCKS = 1024, 65_536, 20_000
# Blocks of one product task.
TASK_BLOCKS = 8
# Eigenvalues below this share of the greatest, per dimension, are rounding: their components are left out.
RANK_SHARE = 2.0**-52


def finite_vector(vec: Column) -> Column:
    """True for a vector that is neither null nor empty and holds no null, NaN or infinity."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.coalesce(bad, F.lit(True))


def _indexed(vecs: DataFrame, dims: int) -> tuple[DataFrame, int]:
    """`vecs` with a gapless `index`: rows are numbered within the partitions of a written table, and the counts of
    the partitions (one row each on the driver) give their offsets."""
    stored = written(vecs.withColumn("_at", F.monotonically_increasing_id()), "vectors")
    part = F.shiftright("_at", 33)
    counts = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()
    offsets, total = {}, 0
    for r in counts:
        offsets[r["part"]], total = total, total + r["rows"]
    if not total:
        return stored.select("id", "x", F.lit(0).cast("long").alias("index")), 0
    table = stored.sparkSession.createDataFrame(list(offsets.items()), "part long, first long")
    rows = stored.join(F.broadcast(table), part == F.col("part"))
    return rows.select("id", "x", (F.col("first") + F.col("_at").bitwiseAND(F.lit(2**33 - 1))).alias("index")), total


def _rows(matrix: IndexedRowMatrix) -> DataFrame:
    """(index, values) of an indexed row matrix, in the JVM."""
    df = callMLlibFunc("getIndexedRows", matrix._java_matrix_wrapper._java_model)
    return df.select(F.col("index"), vector_to_array("vector").alias("values"))


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left x right; with `splits` the middle dimension is cut into as many tasks, whose sums are added."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def whiten(vecs: DataFrame, components: int = 8) -> DataFrame:
    """`vecs` (id, x: array<long>) → id, component, n, deviation, whitened, explained, identity_error.

    All rows are fitted.  n rows have the per-dimension sums S; a centred row is (n * x - S) / n, rounded once, and
    `deviation` is the exact sum of (n * x - S)^2 (null if it does not fit a long).  Components are unit eigenvectors
    of the covariance (divisor n) by falling eigenvalue e; `whitened` is the centred row on the component over
    sqrt(e), `explained` is e over the trace, `identity_error` the greatest entry of |covariance of whitened - I|.
    Components without variance are left out, so equal rows, a single row or an empty table give no rows.  Repeated
    ids and rows each count; a null id stays; x must not be null, hold nulls or be empty (`finite_vector`); vectors
    of different lengths raise.  Other columns are not read.
    """
    spark = vecs.sparkSession
    sizes = vecs.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} dimensions")
    dims = sizes[0] or 0
    kind = vecs.schema["id"].dataType.simpleString()
    none = spark.createDataFrame([], f"id {kind}, component int, n long, deviation long, whitened double, "
                                     "explained double, identity_error double")
    if not dims:
        return none
    rows, n = _indexed(vecs.select("id", F.col("x").cast("array<bigint>").alias("x")), dims)
    sums = rows.agg(*[F.sum(F.get("x", F.lit(d)).cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]).first()
    shifted = F.zip_with("x", F.array(*[F.lit(int(s)) for s in sums]), lambda x, s: x * F.lit(n) - s)
    square = F.aggregate("shifted", F.lit(0).cast("decimal(38,0)"),
                         lambda t, v: (t + v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast("decimal(38,0)"))
    table = rows.select("id", "index", shifted.alias("shifted"))
    table = written(table.select("id", "index", F.expr("transform(shifted, v -> v / cast(%d as double))" % n).alias("centred"),
                                 square.try_cast("long").alias("deviation")), "centred")

    block_rows = min(max(BLOCK_ROWS, ceil(n / BLOCKS)), MAX_BLOCK_ROWS)
    splits = max(1, ceil(n / block_rows / TASK_BLOCKS))
    indexed = table.select("index", array_to_vector("centred").alias("vector"))
    centred = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(indexed, "vector"), n, dims).toBlockMatrix(block_rows, dims)
    covariance = _product(centred.transpose(), centred, splits).toLocalMatrix().toArray() / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [i for i in range(min(components, dims)) if values[i] > dims * RANK_SHARE * max(values[0], 0)]
    if not kept:
        return none
    scale = vectors[:, kept] / np.sqrt(values[kept])
    block = DenseMatrix(dims, len(kept), scale.ravel(order="F").tolist())
    weights = BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), dims, len(kept), dims, len(kept))
    projected = written(_rows(_product(centred, weights, 1).toIndexedRowMatrix()), "projected")

    pairs = [(i, j) for i in range(len(kept)) for j in range(i + 1)]
    value = [F.get("values", F.lit(i)) for i in range(len(kept))]
    error = projected.agg(F.greatest(*[F.abs(F.covar_pop(value[i], value[j]) - float(i == j)) for i, j in pairs], F.lit(0.0))).first()[0]
    shares = F.array(*[F.lit(float(values[i] / values.sum())) for i in kept])
    out = table.select("id", "index", "deviation").join(projected, "index")
    out = out.select("id", "deviation", F.posexplode("values").alias("at", "whitened"))
    return out.select("id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(shares, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))


def scaled(embedding: Column) -> Column:
    """floor(1024 * c) + 100000 of each entry as a double, as long."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * 1024).cast("long") + F.lit(100_000).cast("long"))
