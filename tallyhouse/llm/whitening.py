"""Whitening of embeddings by shifted CholeskyQR.

The centred vectors Y are never brought together: a pass over the table sums their Gram matrix (d x d numbers,
whatever the number of rows), its Cholesky factor R1 is found on the driver, and the next pass sums the Gram
matrix of Y R1^-1, by triangular solves in the tasks. After two or three passes the rows are orthonormal, so
Y = Q R with R the product of the factors, and the singular values and right vectors of the small R are those
of Y. A shift of the diagonal keeps the first factorisation possible when vectors nearly depend on each other;
the later passes take its effect out again, which is why the result is as accurate as a QR of the rows
themselves, where the eigenvalues of a covariance matrix alone would lose half of the digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.llm.store import Spool

#: Entries become whole numbers: SCALE parts of one, moved up by OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Entries from here on have no whole number that sums could hold; their vectors count as non-finite.
LARGEST = float(1 << 42)
#: Passes at most, and the distance from the identity at which rows count as orthonormal.
PASSES, ORTHONORMAL = 8, 1e-11
#: Singular values below this part of the largest are none.
RANK = 1e-10

EMPTY = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whole(vector: Column) -> Column:
    """The entries as whole numbers: floor(1024 * c) + 100000."""
    return F.transform(vector, lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(OFFSET))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its entries are finite (and below 2 ** 42)."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, size).astype(np.int64)


def _totals(size: int):
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, np.zeros(size, np.int64), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), size)
            n, sums = n + len(x), sums + x.sum(0)
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (np.arange(size, dtype=np.int32), np.full(size, n), sums, low, high)],
                ["place", "n", "total", "low", "high"],
            )

    return total


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """`rows` times the inverse of an upper triangular factor, by forward substitution over its columns."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _products(size: int, means: np.ndarray, change):
    """Sums of products of all pairs of columns of the changed, centred rows, one row for each pair."""

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = None
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = change(_matrix(batch.column("x").slice(start, 4096), size) - means)
                gram = part.T @ part if gram is None else gram + part.T @ part
        if gram is not None:
            i, j = np.triu_indices(len(gram))
            cells = (i * len(gram) + j).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(gram[i, j])], ["cell", "value"])

    return product


def _gram(vectors: DataFrame, size: int, means: np.ndarray, change, wide: int) -> np.ndarray:
    """The Gram matrix of the changed rows; `wide * (wide + 1) / 2` sums come to the driver."""
    sums = (
        vectors.select("x")
        .mapInArrow(_products(size, means, change), "cell int, value double")
        .groupBy("cell")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )
    gram = np.zeros(wide * wide)
    gram[sums["cell"].to_numpy()] = sums["value"].to_numpy()
    gram = gram.reshape(wide, wide)
    return gram + np.triu(gram, 1).T


def cholesky(gram: np.ndarray) -> np.ndarray:
    """The upper factor of a Gram matrix, its diagonal shifted as little as it needs."""
    size = len(gram)
    unit = np.finfo(float).eps / 2
    shift = 11 * unit * size * (size + 1) * np.linalg.norm(gram, 2)
    for power in range(12):
        try:
            return np.linalg.cholesky(gram + shift * 10**power * np.eye(size)).T
        except np.linalg.LinAlgError:
            continue
    raise ValueError("the Gram matrix is not one of finite rows")


def components(gram_of, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors (as rows) of rows of which `gram_of(factors)` gives Gram matrices.

    `gram_of` divides the rows by the given triangular factors in their order first. A last Gram matrix that
    is still not the identity (rows that depend on each other) goes into the small decomposition.
    """
    factors: list[np.ndarray] = []
    product = np.eye(size)
    for _ in range(PASSES):
        gram = gram_of(factors)
        if not gram.any() or (factors and np.abs(gram - np.eye(size)).max() <= ORTHONORMAL):
            break
        factors.append(cholesky(gram))
        product = factors[-1] @ product
    else:
        gram = gram_of(factors)
    values, vectors = np.linalg.eigh(gram)
    small = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T @ product
    _, singular, right = np.linalg.svd(small)
    most = np.abs(right).argmax(1)
    return singular, right * np.sign(right[np.arange(size), most])[:, None]


def _projected(size: int, n: int, sums: np.ndarray, means: np.ndarray, loads: np.ndarray, small: bool):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            if small:
                far = ((n * x - sums) ** 2).sum(1).tolist()
            else:
                far = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
            made = (x - means) @ loads
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array([Decimal(v) for v in far], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1, dtype=np.int32) * made.shape[1]), pa.array(made.ravel())
                    ),
                ],
                ["doc", "deviation", "whitened"],
            )

    return project


def whiten(
    rows: DataFrame, vector: str = "embedding", keep: list[str] | None = None, most: int = 8
) -> DataFrame:
    """Every vector's coordinates along the `most` strongest principal components, each of variance one.

    Returns for each usable row and component `doc` (a struct of the columns `keep`, by default all),
    `component` (from 1), `n` (vectors fitted), `deviation` (sum of (n * x - S) ** 2 over the dimensions, exact),
    `whitened`, `explained` (share of all variance) and `identity_error` (of the covariance of `whitened`).
    x is `whole` of the entries and S its sums. Null vectors and vectors with null or non-finite entries are
    left out, as are those of another length than the most frequent one (the longest of several) and empty
    ones. Repeated rows count each. Directions without variance are no components, so a single vector, equal
    vectors and empty tables give no rows. Of each component the largest entry is positive.
    """
    spark = rows.sparkSession
    spool = Spool(spark, "whitening")
    keep = rows.columns if keep is None else keep
    given = rows.select(F.struct(*keep).alias("doc"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    found = spool.write(given.select("doc", whole(F.col("vector")).alias("x")))
    lengths = found.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    schema = StructType([found.schema["doc"], *StructType.fromDDL(EMPTY)])
    if not size:
        return spark.createDataFrame([], schema)
    vectors = found.where(F.size("x") == size)
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    totals = (
        vectors.select("x")
        .mapInArrow(_totals(size), "place int, n long, total long, low long, high long")
        .groupBy("place")
        .agg(F.sum("n").alias("n"), big("total"), F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("place")
        .collect()
    )
    n, sums = totals[0]["n"], [int(r["total"]) for r in totals]
    means = np.array([s / n for s in sums])
    widest = max(r["high"] - r["low"] for r in totals)
    furthest = max(abs(x) for r in totals for x in (r["low"], r["high"]))
    small = n * furthest < 1 << 62 and (n * widest) ** 2 * size < 1 << 62

    def divided(factors):
        def change(part: np.ndarray) -> np.ndarray:
            for factor in factors:
                part = solved(part, factor)
            return part

        return change

    singular, right = components(lambda fs: _gram(vectors, size, means, divided(list(fs)), size), size)
    held = int((singular > RANK * singular[0]).sum()) if singular[0] > 0 else 0
    held = min(held, most)
    if not held:
        return spark.createDataFrame([], schema)
    loads = right[:held].T * (np.sqrt(n) / singular[:held])
    covariance = _gram(vectors, size, means, lambda part: part @ loads, held) / n
    error = float(np.abs(covariance - np.eye(held)).max())
    explained = singular[:held] ** 2 / (singular**2).sum()
    made = vectors.mapInArrow(
        _projected(size, n, np.array(sums) if small else sums, means, loads, small),
        StructType([found.schema["doc"], *StructType.fromDDL("deviation decimal(38,0), whitened array<double>")]),
    )
    return made.select(
        "doc", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "doc",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*map(F.lit, explained.tolist())), F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
