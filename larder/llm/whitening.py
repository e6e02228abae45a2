"""Whitening of embeddings with MLlib's BlockMatrix.

The distinct vectors get consecutive row numbers, are centred exactly (as
whole numbers n * x - S) and become the dense blocks of a BlockMatrix.  Its
transpose times itself gives the scatter, whose eigenvectors come from one
local ``eigh`` (a matrix of the vectors' length, not of the rows).  The blocks
times the whitening matrix project all rows.  The rows of the table find their
vector's projection by an equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import numbered, slices, stored
from larder.llm.vectors import scaled, usable

SCALE, SHIFT = 64, 1_000_000
# Bytes of a block of centred rows.
BLOCK_BYTES = 2 << 20
# Eigenvalues at most this part of the largest one count as zero.
LEAST_PART = 1e-12
LONG = 1 << 63


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), width)


def sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for batch in slices(batches, 8192):
            n += batch.num_rows
            total += _matrix(batch.column("x"), width).sum(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], ["n", "s"])

    parts = fit.select("x").mapInArrow(run, "n long, s array<long>")
    places = parts.select("n", F.posexplode("s").alias("place", "s"))
    by_place = places.groupBy("place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found = by_place.orderBy("place").collect()  # a row for each entry of a vector
    return (found[0]["n"], [r["s"] for r in found]) if found else (0, [])


def _deviations(apart: np.ndarray) -> list[int | None]:
    """Exact sums of squares of whole numbers; null where no long holds it."""
    if len(apart) and int(np.abs(apart).max()) ** 2 * apart.shape[1] < LONG:
        return (apart * apart).sum(1).tolist()
    exact = [sum(v * v for v in row) for row in apart.tolist()]
    return [v if v < LONG else None for v in exact]


def centred_blocks(fit: DataFrame, n: int, total: list[int], rows_per_block: int) -> DataFrame:
    """(block, n_rows, data): centred rows as doubles, a column after the other."""
    width, s = len(total), np.array(total, np.int64)

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("at").to_numpy())
        x = _matrix(group.column("x").combine_chunks(), width)[order]
        data = ((x * n - s) / n).astype("<f8").tobytes(order="F")
        return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int64()),
                         "n_rows": pa.array([len(order)], pa.int32()), "data": pa.array([data], pa.binary())})

    numbered = fit.withColumn("block", F.floor(F.col("at") / rows_per_block).cast("long"))
    return numbered.groupBy("block").applyInArrow(run, "block long, n_rows int, data binary")


def _block_matrix(blocks: DataFrame, rows_per_block: int, n: int, width: int) -> BlockMatrix:
    """The blocks as MLlib takes them: an RDD, there is no other form."""
    dense = blocks.rdd.map(lambda r: ((r["block"], 0), DenseMatrix(r["n_rows"], width, np.frombuffer(r["data"], "<f8"))))
    return BlockMatrix(dense, rows_per_block, width, n, width)


def _product(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``a.multiply(b)`` with the inner blocks dealt over ``splits`` tasks for
    each block of the result (Python's method has no such parameter)."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def scatter(matrix: BlockMatrix, n_blocks: int, tasks: int) -> np.ndarray:
    return _product(matrix.transpose(), matrix, max(1, min(n_blocks, tasks))).toLocalMatrix().toArray()


def components(spread: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues by fall, unit eigenvectors as columns, and the trace."""
    v = spread / n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = [k for k in np.argsort(-values, kind="stable")[:most] if values[k] > max(values.max() * LEAST_PART, 0)]
    return values[order], vectors[:, order], float(np.trace(v))


def projected(spark: SparkSession, matrix: BlockMatrix, whitener: np.ndarray, rows_per_block: int) -> DataFrame:
    """(at, w): the matrix times ``whitener``, a row of it for each row."""
    width, k = whitener.shape
    local = DenseMatrix(width, k, whitener.flatten(order="F"))
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), local)], 1), width, k, width, k)
    blocks = _product(matrix, right).blocks.map(
        lambda b: (b[0][0], np.ascontiguousarray(b[1].toArray(), "<f8").tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), strict=True):
                w = np.frombuffer(data, "<f8")
                at = block * rows_per_block + np.arange(len(w) // k)
                ends = pa.array(np.arange(0, len(w) + 1, k, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.ListArray.from_arrays(ends, pa.array(w))], ["at", "w"])

    return spark.createDataFrame(blocks, "block long, data binary").mapInArrow(run, "at long, w array<double>")


def identity_error(table: DataFrame, n: int, k: int) -> float:
    """Largest entry of the covariance of ``w``, centred first, minus the identity."""

    def partial(mean: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k if mean is None else k * k)
            for batch in slices(batches, 8192):
                w = _matrix(batch.column("w"), k)
                total += w.sum(0) if mean is None else ((w - mean).T @ (w - mean)).ravel()
            place = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([place, pa.array(total)], ["place", "v"])

        parts = table.select("w").mapInArrow(run, "place int, v double")
        found = parts.groupBy("place").agg(F.sum("v").alias("v")).orderBy("place").collect()  # at most k * k numbers
        return np.array([r["v"] for r in found])

    mean = partial(None) / n
    return float(np.abs(partial(mean).reshape(k, k) / n - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16) -> DataFrame:
    """Whitened components of each row: id, component, n, deviation, whitened,
    explained, identity_error.

    Entries c become floor(64 * c) + 1000000.  The fit list holds each distinct
    vector once; n is its length.  Rows whose vector is null, empty, of another
    length than most, or holds null, NaN or infinite entries are left out.
    Repeated rows and null ids stay.  Components are those of positive
    variance, ``most`` at most, so a table of one distinct vector has none; an
    empty table gives none.  ``deviation`` is null where no long holds it;
    entries must be small enough that n * x is a long.  Other columns are not
    read.
    """
    spark = df.sparkSession
    rows = usable(df.select(df[id_col].alias("id"), df[vector_col].alias("v")), "v")
    rows = stored(spark, rows.select("id", scaled(F.col("v"), SCALE, SHIFT).alias("x")), "whitening-rows")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    first = rows.select(F.size("x").alias("width")).head(1)
    if not first:
        return spark.createDataFrame([], schema)
    width = first[0]["width"]
    fit = numbered(rows.select("x").distinct(), "at", "whitening-fit").select("at", "x")
    n, total = sums(fit, width)

    rows_per_block = max(1, BLOCK_BYTES // (8 * width))
    n_blocks = -(-n // rows_per_block)
    blocks = stored(spark, centred_blocks(fit, n, total, rows_per_block), "whitening-blocks")
    matrix = _block_matrix(blocks, rows_per_block, n, width)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values, vectors, trace = components(scatter(matrix, n_blocks, tasks), n, most)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    whitened = stored(spark, projected(spark, matrix, vectors / np.sqrt(values), rows_per_block), "whitening-projected")
    error = identity_error(whitened, n, k)

    s = np.array(total, np.int64)

    def deviation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            apart = _matrix(batch.column("x"), width) * n - s
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("x"), pa.array(_deviations(apart), pa.int64())], ["at", "x", "deviation"])

    of_vector = fit.mapInArrow(deviation, "at long, x array<long>, deviation long").join(whitened, "at")
    # The rows' side of a frequent vector can be split, its own side is one row.
    out = rows.join(of_vector.select(F.xxhash64("x").alias("h"), F.col("x").alias("fx"), "deviation", "w"),
                    (F.xxhash64(rows["x"]) == F.col("h")) & (rows["x"] == F.col("fx")))
    explained = F.array([F.lit(float(v / trace)) for v in values])
    out = out.select("id", "deviation", F.posexplode("w").alias("place", "whitened"))
    return out.select(
        F.col("id").alias(id_col), (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("place")].alias("explained"), F.lit(error).alias("identity_error"))
