"""Whitening by passes over the rows against the covariance matrix of all rows at once."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest

from __spark_entry__ import queries
from tallyhouse.llm import whitening

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, doc string, x int, n string"


def plain(vectors):
    """(x, deviation, eigenvalues, vectors as rows) of a list of vectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    far = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[a - s / n for a, s in zip(row, sums, strict=True)] for row in x])
    _, singular, right = np.linalg.svd(centred)
    return centred, far, singular**2 / n, right


def compare(rows, keys, vectors, most=8):
    centred, far, values, right = plain(vectors)
    held = min(most, int((values > 1e-18 * values[0]).sum()))
    assert len(rows) == held * len(keys)
    at = {k: i for i, k in enumerate(keys)}
    got = np.zeros((len(keys), held))
    for r in rows:
        i, c = at[r["vec_id"]], r["component"] - 1
        got[i, c] = r["whitened"]
        assert r["n"] == len(keys) and int(r["deviation"]) == far[i]
        assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
        assert r["identity_error"] <= 1e-8
    wanted = centred @ right[:held].T / np.sqrt(values[:held])
    wanted *= np.sign((wanted * got).sum(0))
    assert np.abs(got - wanted).max() < 1e-6
    assert np.abs(got.T @ got / len(got) - np.eye(held)).max() < 1e-8


def flat(frame):
    return [r.asDict() | {"vec_id": r["doc"]["vec_id"]} for r in frame.collect()]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_against_the_whole_matrix(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    table = [r for r in table if r["embedding"] and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    rows = [r.asDict() for r in queries()["op12_whitening"](spark, FOLDER).collect()]
    compare(rows, [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_rows_that_do_not_count(spark):
    nan, inf = float("nan"), float("inf")
    good = np.random.default_rng(1).normal(size=(50, 5)).astype(np.float32).tolist()
    rows = [(k, v, "clash", 1, "y") for k, v in enumerate(good)]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [1e30] * 5, [1.0, 2.0]]
    rows += [(100 + k, v, None, None, None) for k, v in enumerate(bad)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = whitening.whiten(docs)
    compare(flat(found), list(range(50)), good)
    assert {r["doc"]["doc"] for r in found.collect()} == {"clash"}


def test_nearly_dependent_dimensions_keep_their_digits(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 2)) * 1000
    wide = np.hstack([base, base @ [[1.0], [1.0]] + rng.normal(size=(300, 1)) * 0.01])
    vectors = wide.astype(np.float32).tolist()
    docs = spark.createDataFrame([(k, v, "", 0, "") for k, v in enumerate(vectors)], SCHEMA)
    compare(flat(whitening.whiten(docs)), list(range(300)), vectors)


def test_dependent_dimensions_and_repeats_give_fewer_components(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-5, 6, size=(40, 3))
    vectors = np.hstack([base, base[:, :1], np.ones((40, 2))]).astype(float)
    vectors[1] = vectors[0]
    docs = spark.createDataFrame([(k, v, "", 0, "") for k, v in enumerate(vectors.tolist())], SCHEMA)
    compare(flat(whitening.whiten(docs)), list(range(40)), vectors.tolist())
    compare(flat(whitening.whiten(docs, most=2)), list(range(40)), vectors.tolist(), most=2)


def test_tables_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0], "", 0, "")], [(k, [3.0, 4.0], "", 0, "") for k in range(9)], [(1, None, "", 0, "")]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_deviations_beyond_64_bits(spark):
    vectors = [[4e9 * (k % 7), float(k)] for k in range(60)]
    docs = spark.createDataFrame([(k, v, "", 0, "") for k, v in enumerate(vectors)], SCHEMA)
    rows = flat(whitening.whiten(docs))
    _, far, _, _ = plain(vectors)
    assert max(far) > 1 << 64
    assert all(int(r["deviation"]) == far[r["vec_id"]] for r in rows)


def test_triangular_solve_and_shifted_factor():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(30, 6))
    factor = whitening.cholesky(rows.T @ rows)
    assert np.allclose(np.tril(factor, -1), 0)
    assert np.allclose(whitening.solved(rows, factor) @ factor, rows)
    assert np.isfinite(whitening.cholesky(np.ones((4, 4)))).all()
