"""Whitening of embeddings with distributed block matrices of Spark MLlib.

The distinct vectors are numbered, centred and put into blocks of rows. Their scatter
is the transposed matrix times the matrix, a sum over blocks of rows; it is as large
as a vector is long, squared, and its eigenvectors are worked out locally. The blocks times the
whitening matrix are the projected rows. Everything that grows with the table stays in Spark; the
driver sees the numbers of blocks and of partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table, written

COMPONENTS = 16
# Blocks are as large as many rows need them to be, but within these bounds.
BLOCK_BYTES, LEAST_ROWS, BLOCKS, BLOCK_COLUMNS = 32 << 20, 1024, 4096, 1024
# Entries below are whole numbers that squares and sums leave exact.
LARGEST_ENTRY = 1 << 40


@dataclass(frozen=True)
class Whitening:
    """What was learned from the distinct vectors, and their projections.

    ``rows`` has ``x``, ``deviation`` and ``whitened`` (array of doubles) of each distinct vector.
    ``variances`` fall; ``total`` is the sum of all, those of components left out included.
    ``identity_error`` is how far the covariance of ``whitened`` is from the identity.
    """

    rows: DataFrame
    count: int
    sums: list[int]
    variances: list[float]
    total: float
    identity_error: float


def whole_vectors(embeddings: DataFrame, scale: int, shift: int) -> DataFrame:
    """``vec_id`` and ``x``, the entries times ``scale``, rounded down, and shifted."""
    finite = "forall(embedding, c -> coalesce(abs(cast(c as double)) < double('infinity'), false))"
    usable = f"embedding is not null and {finite}"
    small = f"""forall(embedding, c -> abs({scale} * cast(c as double)) < {LARGEST_ENTRY})"""
    entries = f"transform(embedding, c -> cast(floor({scale} * cast(c as double)) as long) + {shift})"
    large = F.raise_error(F.lit(f"an entry is {LARGEST_ENTRY} or more")).cast("array<long>")
    # Conditions on x may be looked at before the rows have been filtered.
    x = F.when(F.expr(f"{usable} and {small}"), F.expr(entries)).when(F.expr(usable), large)
    return embeddings.where(usable).select("vec_id", x.alias("x"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of a written table with ``place`` get ``index``, counted from 0 without gaps.

    A place is a row's number in the task that wrote it; there is one offset for each such task.
    """
    task = F.shiftright("place", 33)
    counts = rows.groupBy(task.alias("task")).count().orderBy("task").collect()
    ends = np.cumsum([row["count"] for row in counts])
    offsets = [(row["task"], int(end) - row["count"]) for row, end in zip(counts, ends)]
    starts = rows.sparkSession.createDataFrame(offsets, "task long, start long")
    index = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("task", task).join(F.broadcast(starts), "task").withColumn("index", index).drop("task", "start")


def _product(one: BlockMatrix, other: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """Matrix product; ``splits`` is in how many parts the sums over the inner dimension are worked out."""
    product = one._java_matrix_wrapper.call("multiply", other._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, one.rowsPerBlock, other.colsPerBlock)


def _covariance(blocks: BlockMatrix, count: int, splits: int) -> np.ndarray:
    """Of centred columns, by a sum over the blocks of rows."""
    return _product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray() / count


def _blocks_of(spark: SparkSession, matrix: np.ndarray, rows: int) -> BlockMatrix:
    """A local matrix in blocks of so many rows."""
    parts = [matrix[start : start + rows] for start in range(0, len(matrix), rows)]
    blocks = [((i, 0), Matrices.dense(*part.shape, part.ravel("F").tolist())) for i, part in enumerate(parts)]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), rows, matrix.shape[1], *matrix.shape)


def _sums(fit: DataFrame, length: int) -> list[int]:
    totals = fit.select(F.posexplode("x").alias("i", "entry")).groupBy("i").agg(F.sum("entry").alias("total"))
    found = {row["i"]: row["total"] for row in totals.collect()}
    return [found[i] for i in range(length)]


def _numbers(values: list, kind: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from the distinct ``x`` (arrays of whole numbers, all of one length) and project them.

    Components without variance, but for rounding, are left out. None where there are no rows.
    """
    spark = vectors.sparkSession
    fit = vectors.groupBy("x").agg(F.count("*").alias("copies"))
    fit = written(fit.select("x", F.monotonically_increasing_id().alias("place")), "distinct-vectors")
    count = fit.count()
    if not count:
        return None
    length = len(fit.first()["x"])
    sums = _sums(fit, length)
    means = _numbers([total / count for total in sums], "double")
    centred = F.zip_with("x", means, lambda entry, mean: entry.cast("double") - mean)
    fit = _numbered(fit)
    rows = fit.select("index", array_to_vector(centred).alias("vector"))
    rows = MLUtils.convertVectorColumnsFromML(rows, "vector")
    columns = min(length, BLOCK_COLUMNS)
    size = min(max(count // BLOCKS, LEAST_ROWS), max(BLOCK_BYTES // (8 * columns), 1))
    blocks = IndexedRowMatrix(rows, count, length).toBlockMatrix(size, columns)
    # Four passes read them; what a lost executor held is worked out again.
    blocks.persist(StorageLevel.MEMORY_AND_DISK)
    splits = -(-count // size)
    scatter = _covariance(blocks, count, splits)
    values, directions = np.linalg.eigh((scatter + scatter.T) / 2)
    values, directions = values[::-1], directions[:, ::-1]
    total = float(np.trace(scatter))
    kept = int((values[:components] > max(values[0], 0) * length * np.finfo(float).eps).sum())
    if not kept:
        rows = fit.select("x", F.array().cast("array<double>").alias("whitened"))
        error = 0.0
    else:
        matrix = directions[:, :kept] / np.sqrt(values[:kept])
        projected = _product(blocks, _blocks_of(spark, matrix, columns))
        covariance = _covariance(projected, count, splits)
        error = float(np.abs(covariance - np.eye(kept)).max())
        found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        found = found.select("index", vector_to_array("vector").alias("whitened"))
        rows = fit.join(found, "index").select("x", "whitened")
    # Exact in whole numbers, as long as it fits.
    apart = F.zip_with("x", _numbers(sums, "long"), lambda entry, total: F.lit(count) * entry - total)
    about = F.aggregate(apart, F.lit(0.0), lambda so_far, part: so_far + part.cast("double") * part.cast("double"))
    exact = F.aggregate(apart, F.lit(0).cast("long"), lambda so_far, part: so_far + part * part)
    large = F.raise_error(F.lit("a deviation does not fit 64 bits")).cast("long")
    rows = rows.withColumn("deviation", F.when(about < 9e18, exact).otherwise(large))
    rows = written(rows, "whitened")
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return Whitening(rows, count, sums, [float(value) for value in values[:kept]], total, error)


COLUMNS = (
    "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whitened_rows(
    embeddings: DataFrame, components: int = COMPONENTS, scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """A row for each vector and component: ``vec_id``, ``component`` (from 1), ``n`` distinct vectors,
    ``deviation`` from the mean, ``whitened``, the share of variance ``explained``, ``identity_error``.

    ``embeddings`` has ``vec_id`` and ``embedding``; other columns are not looked at. Entries are multiplied by
    ``scale``, rounded down and shifted. Vectors that are null or have a null or non-finite entry are
    left out. All have the length that most have (the longer of two that as many have); others are left out.
    Repeated rows each give rows, but count once in what is learned; ``vec_id`` may be null or repeated.
    Components without variance are left out, so there may be fewer than asked for, or none.
    No vectors give no rows. Entries of 2^40 or more, and deviations that do not fit 64 bits, raise an error.
    """
    spark = embeddings.sparkSession
    empty = spark.createDataFrame([], COLUMNS.format(embeddings.schema["vec_id"].dataType.simpleString()))
    vectors = whole_vectors(embeddings.select("vec_id", "embedding"), scale, shift)
    lengths = vectors.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if lengths is None or not lengths["length"]:
        return empty
    vectors = vectors.where(F.size("x") == lengths["length"])
    learned = whitening(vectors, components)
    # A vector that very many rows have is split by the adaptive skew join.
    mine = vectors.withColumn("hash", F.xxhash64("x"))
    theirs = learned.rows.withColumn("hash", F.xxhash64("x"))
    joined = mine.join(theirs, ["hash", "x"]).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    explained = _numbers([value / learned.total for value in learned.variances], "double")
    return joined.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(learned.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("i")).alias("explained"),
        F.lit(learned.identity_error).alias("identity_error"),
    )


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_rows(table(spark, folder, "embeddings"))
