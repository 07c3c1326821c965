"""Whitening of embedding vectors on distributed block matrices.

Entries become whole numbers, so sums and deviations are exact. The rows, centred, are indexed
into the blocks of a BlockMatrix; its transpose times itself is the scatter matrix, a local
``eigh`` gives its eigenvectors, and the block matrix times the whitening matrix projects the
rows. The driver holds matrices of dimension x dimension, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col, stored

SCALE, SHIFT = 1024, 100_000
BLOCK_ROWS = 1024
# Beyond this a scaled entry counts as not finite.
MOST = float(1 << 52)
_LOW33 = (1 << 33) - 1


def whole_entries(vector: Column) -> Column:
    """floor(1024 c) + 100,000 for each entry c."""
    return F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)


def usable(vector: Column) -> Column:
    """False for null and empty vectors and those with an entry that is null or not finite."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) >= MOST / SCALE)

    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def fit_rows(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int, int]:
    """(``index`` from 0, ``vec_id``, ``x``; rows; dimension): the usable rows, written once.

    Of vectors of several lengths those of the most frequent length stay, of the shortest of
    these if there is a tie.
    """
    entries = col(vector).cast("array<double>")
    kept = df.select(col(key).alias("vec_id"), entries.alias("v")).where(usable(F.col("v")))
    lengths = kept.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return kept.select(F.lit(0).cast("long").alias("index"), "vec_id", whole_entries(F.col("v")).alias("x")), 0, 0
    placed = kept.where(F.size("v") == lengths.d).select("vec_id", whole_entries(F.col("v")).alias("x"))
    placed = stored(placed.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "vectors")
    # The rows of a part are numbered behind those of earlier parts; one row for each part.
    counts = stored(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    index = F.col("start") + F.col("place").bitwiseAND(F.lit(_LOW33))
    rows = placed.join(starts, "part").select(index.alias("index"), "vec_id", "x")
    return rows, int(lengths.n), int(lengths.d)


def sums_of(rows: DataFrame, dimension: int) -> list[int]:
    """The exact sum of each dimension."""
    sums = rows.select(F.posexplode("x").alias("d", "x")).groupBy("d").agg(F.sum("x").alias("s")).collect()
    by = {r.d: r.s for r in sums}
    return [by.get(d, 0) for d in range(dimension)]


def centred_blocks(rows: DataFrame, n: int, sums: list[int], block_rows: int) -> BlockMatrix:
    """The rows less their mean, indexed into blocks of ``block_rows`` rows and all columns."""
    mean = F.array(*[F.lit(s / n) for s in sums])
    centred = rows.select("index", array_to_vector(F.zip_with("x", mean, lambda x, m: x - m)).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(centred, "vector"), n, len(sums))
    return matrix.toBlockMatrix(block_rows, len(sums))


def multiplied(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left`` times ``right``, the inner dimension spread over ``splits`` tasks for each block of
    the product (the Python method has no parameter for that)."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def whitening_matrix(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(matrix to multiply with, eigenvalues, trace) of up to ``components`` components.

    Components without variance have no whitened values and are left out. The largest entry of an
    eigenvector is positive.
    """
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    trace = float(np.trace(covariance))
    some = values > max(trace, 0.0) * len(scatter) * np.finfo(np.float64).eps
    values, vectors = values[some], vectors[:, some]
    if len(values):
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return vectors / np.sqrt(values), values, trace


def identity_error(white: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of ``z`` less the identity; centred first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Count, mean and centred products of a part, batch by batch.
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            if len(z):
                n, mean, products = _merged((n, mean, products), (len(z), z.mean(axis=0), _scatter(z)))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]), pa.array([products.ravel().tolist()])], ["n", "mean", "products"])

    total = (0, np.zeros(k), np.zeros((k, k)))
    for r in white.select("z").mapInArrow(moments, "n long, mean array<double>, products array<double>").collect():  # a row for each part
        total = _merged(total, (r.n, np.array(r["mean"]), np.array(r.products).reshape(k, k)))
    return float(np.abs(total[2] / total[0] - np.eye(k)).max())


def _scatter(z: np.ndarray) -> np.ndarray:
    centred = z - z.mean(axis=0)
    return centred.T @ centred


def _merged(a, b):
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


SCHEMA = (
    "vec_id {key}, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_exact decimal(38,0)"
)


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """A row for each usable vector and component: ``vec_id``, ``component`` (from 1, by falling
    eigenvalue), ``n`` (vectors), ``deviation`` (sum over dimensions of (n x - S)^2 where S are the
    sums of x), ``whitened``, ``explained``, ``identity_error`` and ``deviation_exact``.

    ``deviation`` is null where it does not fit a long (from some millions of vectors on);
    ``deviation_exact`` has the same number as a decimal of 38 digits. A vector that is null, empty
    or has an entry that is null, not finite or beyond 2^42 is dropped, and so are vectors of another
    length than most. Components without variance (fewer vectors than dimensions, one vector,
    copies of one) give no rows; no vectors give none. Repeated rows are rows of their own, a null
    key is a key, other columns are not read. One block holds ``block_rows`` rows; the driver gets
    the number of each block and two matrices of dimension x dimension.
    """
    kind = df.select(col(key)).schema[0].dataType.simpleString()
    empty = df.sparkSession.createDataFrame([], SCHEMA.format(key=kind))
    rows, n, dimension = fit_rows(df, key, vector)
    if not n:
        return empty
    sums = sums_of(rows, dimension)
    # Used by three products; what a lost executor held of it is built again.
    blocks = centred_blocks(rows, n, sums, block_rows).persist(StorageLevel.MEMORY_AND_DISK)
    splits = -(-n // block_rows)
    scatter = multiplied(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()
    matrix, values, trace = whitening_matrix(scatter, n, components)
    k = len(values)
    if not k:
        blocks._java_matrix_wrapper.call("blocks").unpersist(False)
        return empty
    small = Matrices.dense(dimension, k, matrix.ravel(order="F").tolist())
    whitener = BlockMatrix(df.sparkSession.sparkContext.parallelize([((0, 0), small)], 1), dimension, k, dimension, k)
    projected = multiplied(blocks, whitener, 1).toIndexedRowMatrix()
    # The rows as the DataFrame that the Python property would turn into Python objects.
    white = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    white = MLUtils.convertVectorColumnsToML(white, "vector").select("index", vector_to_array("vector").alias("z"))
    white = stored(white, "whitened")
    blocks._java_matrix_wrapper.call("blocks").unpersist(False)
    error = identity_error(white, k)
    exact = F.lit(0).cast("decimal(38,0)")
    parts = F.zip_with("x", F.array(*[F.lit(s) for s in sums]), lambda x, s: (F.lit(n) * x - s).cast("decimal(19,0)"))
    exact = F.aggregate(parts, exact, lambda all_, d: (all_ + d * d).cast("decimal(38,0)"))
    explained = F.array(*[F.lit(float(v / trace)) for v in values])
    done = rows.select("index", "vec_id", exact.alias("exact")).join(white, "index")
    return done.select("vec_id", "exact", F.posexplode(F.arrays_zip("z", explained.alias("e"))).alias("p", "c")).select(
        "vec_id", (F.col("p") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
        F.when(F.col("exact") <= F.lit((1 << 63) - 1), F.col("exact").cast("decimal(19,0)").cast("long")).alias("deviation"),
        F.col("c.z").alias("whitened"), F.col("c.e").alias("explained"), F.lit(error).alias("identity_error"),
        F.col("exact").alias("deviation_exact"),
    )
