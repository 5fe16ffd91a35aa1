"""Whitening of embeddings by a covariance weighted with multiplicities.

Vectors become integers, identical ones are grouped, and from there on each distinct vector
is one row with a weight: how often it occurs in the fit list (or one, when distinct vectors
shall count once). Sums and covariance come from weighted products over blocks of rows, a
matrix per task, added up in Spark; the centre is taken off before multiplying. The matrix
of the components goes to every task, its size is that of a vector squared (bounded by
MOST_DIMENSIONS). Each distinct vector is whitened once and joined back to its rows: those of
frequent vectors by a broadcast (at most HOT of them), so that a vector which holds a third
of all rows stays where its rows are; the others by a shuffle with few rows a key.

Vectors that are null or empty, or hold a null, NaN or infinite entry, take no part; nor do
vectors of another length than the most frequent one (of equally frequent the longest). Null
ids and repeated ids are rows like others; other columns are left aside. Directions without
variance beyond rounding are no components: equal vectors, a single row or an empty table
give no rows. Entries beyond 2^45 and deviations beyond a long are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagedater.llm.common import picked
from pagedater.session import stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
MOST_DIMENSIONS = 4096
#: Most distinct vectors that are frequent: each holds more than one in HOT of all rows.
HOT = 1_000
#: Rows of a block of a product.
ROWS = 4096
LARGEST = 2.0**45

CELLS = "i int, j int, value double"


@dataclass
class Whitening:
    """What was fitted: rows, sums by dimension, eigenvalues, components as columns, their trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float


def integers(vector: Column) -> Column:
    return F.transform(
        vector, lambda c: (F.floor(c.cast("double") * float(SCALE)) + F.lit(OFFSET)).cast("long")
    )


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)``: the integer vectors that take part."""
    wrong = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    huge = F.exists("embedding", lambda c: F.abs(c.cast("double")) > LARGEST / SCALE)
    read = picked(vectors, "vec_id", "embedding").filter((F.size("embedding") > 0) & ~wrong)
    x = F.when(huge, F.raise_error(F.lit("an entry is too large")).cast("array<bigint>")).otherwise(integers(F.col("embedding")))
    kept = read.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    lengths = kept.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size"))
    first = lengths.first()
    if first and first["size"] > MOST_DIMENSIONS:
        raise ValueError(f"more than {MOST_DIMENSIONS} dimensions")
    return kept.filter(F.size("x") == (first["size"] if first else 0))


def distinct_vectors(rows: DataFrame, by_counts: bool = True) -> DataFrame:
    """``(x, n, weight)``: each distinct vector with its rows and its weight in the fit.

    Counts are partial in each task, so a frequent vector is a row per task in the shuffle.
    """
    return rows.groupBy("x").agg(F.count("*").alias("n")).withColumn("weight", F.col("n") if by_counts else F.lit(1).cast("long"))


def _matrix(column: pa.ListArray, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def weighted_sums(rows: DataFrame, vector: str, kind: str) -> tuple[int, np.ndarray]:
    """Sum of weights, and of weighted vectors by dimension; exact where ``kind`` is long."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), np.int64 if kind == "long" else np.float64)
                own = batch.column(1).to_numpy() @ np.column_stack([np.ones(len(x), x.dtype), x])
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "value"])

    parts = rows.select(vector, "weight").mapInArrow(add, f"i int, value {kind}")
    found = dict(parts.groupBy("i").agg(F.sum("value").alias("value")).collect())
    total = np.array([found[i] for i in range(len(found))], np.int64 if kind == "long" else np.float64)
    return (int(total[0]), total[1:]) if len(total) else (0, total)


def weighted_covariance(rows: DataFrame, vector: str, kind: str, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance with divisor ``n`` about ``sums / n``, centred before it is multiplied."""
    # An integer centre and a remainder: the first difference is exact.
    whole = np.rint(sums / n) if kind == "long" else np.zeros(len(sums))
    rest = (sums - whole.astype(sums.dtype) * n) / n

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(sums)))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                centred = _matrix(part.column(0), np.float64) - whole - rest
                total += (centred * part.column(1).to_numpy()[:, None]).T @ centred
        i, j = np.triu_indices(len(sums))
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "value"]
            )

    out = np.zeros((len(sums), len(sums)))
    cells = rows.select(vector, "weight").mapInArrow(multiply, CELLS)
    for i, j, value in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[i, j] = out[j, i] = value / n
    return out


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance by falling eigenvalue."""
    n, sums = weighted_sums(distinct, "x", "long")
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    covariance = weighted_covariance(distinct, "x", "long", n, sums)
    values, vectors = np.linalg.eigh(covariance)
    trace = float(np.trace(covariance))
    kept = [i for i in np.argsort(-values, kind="stable") if values[i] > len(sums) * np.finfo(float).eps * trace][:components]
    return Whitening(n, sums, values[kept], vectors[:, kept], trace)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over dimensions of ``(n * x - sums) ** 2`` in integers; beyond a long an error."""
    largest = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0))
    gap = x * n - sums if largest < 1 << 63 else x.astype(object) * n - sums.astype(object)
    if int(np.abs(gap).max(initial=0)) ** 2 * len(sums) >= 1 << 63:
        gap = gap.astype(object)
        found = (gap * gap).sum(axis=1)
        if int(found.max()) >= 1 << 63:
            raise OverflowError("a deviation is beyond a long")
        return found.astype(np.int64)
    return (gap * gap).sum(axis=1)


def whitened_vectors(distinct: DataFrame, fitted: Whitening) -> DataFrame:
    """``(x, n, weight, deviation, whitened)`` of every distinct vector."""
    spark = distinct.sparkSession
    shared = spark.sparkContext.broadcast(fitted)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        whole = np.rint(model.sums / model.n)
        rest = (model.sums - whole.astype(np.int64) * model.n) / model.n
        scaled = model.components / np.sqrt(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column(0), np.int64)
                flat = ((x - whole - rest) @ scaled).ravel()
                white = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(model.values), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(deviations(x, model.n, model.sums)), white],
                    names=["x", "n", "weight", "deviation", "whitened"],
                )

    kind = "x array<bigint>, n long, weight long, deviation long, whitened array<double>"
    return distinct.select("x", "n", "weight").mapInArrow(project, kind)


def identity_error(whitened: DataFrame) -> float:
    """Largest entry by which the covariance of whitened vectors differs from the identity."""
    n, sums = weighted_sums(whitened, "whitened", "double")
    covariance = weighted_covariance(whitened, "whitened", "double", n, sums)
    return float(np.abs(covariance - np.eye(len(sums))).max())


def joined_back(rows: DataFrame, whitened: DataFrame, n: int) -> DataFrame:
    """Every row beside what its vector became."""
    hot = F.col("n") * HOT > n
    values = whitened.select("x", "n", "deviation", "whitened")
    frequent = F.broadcast(values.filter(hot).drop("n"))
    names = values.filter(hot).select("x")
    rest = rows.join(F.broadcast(names), "x", "left_anti").join(values.filter(~hot).drop("n"), "x")
    return rows.join(frequent, "x").select("vec_id", "deviation", "whitened").unionByName(
        rest.select("vec_id", "deviation", "whitened")
    )


def whiten(vectors: DataFrame, components: int = COMPONENTS, by_counts: bool = True) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    rows = stage(usable(vectors), "vectors")
    distinct = stage(distinct_vectors(rows, by_counts), "distinct")
    fitted = fit(distinct, components)
    spark = vectors.sparkSession
    if not len(fitted.values):
        return spark.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    whitened = stage(whitened_vectors(distinct, fitted), "whitened")
    error = identity_error(whitened)
    shares = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    found = joined_back(rows, whitened, rows.count())
    found = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return found.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
