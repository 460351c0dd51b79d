"""Whitening against numpy's dense eigenvectors and Python's whole numbers."""

import duckdb
import numpy as np
import pytest

from tidemark.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"
DDL = "vec_id bigint, embedding array<float>, component string, n string, whitened string, x int, part int"


def frame(spark, vectors, ids=None, parts=3):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v, "clash", "clash", "clash", 1, 2) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, DDL).repartition(parts)


def dense(vectors, k=8):
    """Whole numbers, eigenvalues, eigenvectors and trace, by numpy."""
    x = np.floor(np.float32(vectors).astype(np.float64) * 1024) + 100_000
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    values, columns = np.linalg.eigh(v)
    return x, centred, values[::-1][:k], columns[:, ::-1][:, :k], np.trace(v)


def check(df, vectors, ids, k=8):
    x, centred, values, columns, trace = dense(vectors, k)
    rows = df.collect()
    kept = [j for j in range(len(values)) if values[j] > 1e-12 * values[0]]
    assert len(rows) == len(vectors) * len(kept)
    found = {(r.vec_id, r.component): r for r in rows}
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    for j in kept:
        want = centred @ columns[:, j] / np.sqrt(values[j])
        got = np.array([found[i, j + 1].whitened for i in ids])
        sign = 1 if want @ got > 0 else -1
        assert np.abs(got - sign * want).max() < 1e-8
        assert abs(found[ids[0], j + 1].explained / (values[j] / trace) - 1) < 1e-10
    for at, i in enumerate(ids):
        exact = sum((n * int(a) - s) ** 2 for a, s in zip(x[at], sums, strict=True))
        assert int(found[i, 1].deviation) == exact and found[i, 1].n == n
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_query_against_numpy(spark):
    given = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall()
    df = queries.registered()["op12_whitening"](spark, SMALL)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    check(df, [v for _, v in given], [i for i, _ in given])


@pytest.mark.parametrize("size", [1, 3, 40, 70])
def test_sizes_of_vectors(spark, size):
    random = np.random.default_rng(size)
    vectors = (random.standard_normal((90, size)) * np.linspace(1, 3, size)).tolist()
    check(whitening.whitened(frame(spark, vectors)), vectors, range(90), min(8, size))


def test_a_third_of_the_rows_are_one_vector(spark):
    random = np.random.default_rng(3)
    vectors = random.standard_normal((120, 48)).tolist()
    vectors += [vectors[0]] * 60
    check(whitening.whitened(frame(spark, vectors)), vectors, range(180))


def test_what_is_dropped(spark):
    random = np.random.default_rng(4)
    good = random.standard_normal((30, 5)).tolist()
    bad = [None, [], [1.0] * 6, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 1.0, 1.0, 1.0, 1.0],
           [1e30, 1.0, 1.0, 1.0, 1.0]]
    df = whitening.whitened(frame(spark, good + bad, [*range(30), *range(900, 907)]))
    check(df, good, range(30), 5)


def test_ids_may_be_null_or_repeat(spark):
    random = np.random.default_rng(5)
    vectors = random.standard_normal((40, 4)).tolist()
    rows = whitening.whitened(frame(spark, vectors, [None] * 20 + [7] * 20)).collect()
    assert sum(r.vec_id is None for r in rows) == 80 and sum(r.vec_id == 7 for r in rows) == 80


def test_no_components(spark):
    assert whitening.whitened(frame(spark, [[1.0, 2.0]])).collect() == []
    assert whitening.whitened(frame(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert whitening.whitened(frame(spark, [None, []])).collect() == []
    empty = spark.createDataFrame([], DDL)
    assert whitening.whitened(empty).collect() == []


def test_fewer_vectors_than_dimensions(spark):
    random = np.random.default_rng(6)
    vectors = random.standard_normal((4, 64)).tolist()
    check(whitening.whitened(frame(spark, vectors)), vectors, range(4))


def test_ties_give_some_orthonormal_basis(spark):
    vectors = (np.vstack([np.eye(50), -np.eye(50)]) * 2).tolist()
    found = whitening.blocks(frame(spark, vectors), "vec_id", "embedding", 1024, 100_000)
    model = whitening.fit(found)
    assert np.allclose(model.values, model.values[0]) and len(model.values) == 8
    assert np.abs(model.vectors.T @ model.vectors - np.eye(8)).max() < 1e-12
    assert whitening.identity_error(found, model) < 1e-12


def test_a_flat_spectrum_ends_with_more_columns(spark):
    random = np.random.default_rng(8)
    q = np.linalg.qr(random.standard_normal((80, 80)))[0]
    vectors = (np.vstack([q, -q]) * (1 + 1e-4 * np.arange(80))).tolist()
    found = whitening.blocks(frame(spark, vectors), "vec_id", "embedding", 1 << 20, 0)
    model = whitening.fit(found)
    x = np.vstack([found.moments.rows(r.x) for r in found.table.collect()])
    want = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1][:8]
    assert np.abs(model.values / want - 1).max() < 1e-9


def test_large_numbers_stay_exact(spark):
    vectors = [[2.0**40, 1.0], [2.0**40 + 2.0**18, 3.0], [2.0**41, -5.0]]
    df = whitening.whitened(frame(spark, vectors))
    x = [[int(c * 1024) + 100_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((3 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in df.collect()} == want


def test_sums_of_many_tasks_are_added_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    random = np.random.default_rng(9)
    vectors = random.standard_normal((200, 40)).tolist()
    check(whitening.whitened(frame(spark, vectors, parts=9)), vectors, range(200))


def test_the_polynomial_damps_the_unwanted_end():
    class Diagonal:
        def __matmul__(self, q):
            return values[:, None] * q

    values = np.linspace(0, 10, 101)
    q = np.eye(101)
    out = np.diag(whitening.filtered(Diagonal(), q, values[:, None] * q, 0.0, 8.0, 10.0, 9))
    t = np.cosh(9 * np.arccosh((10 - 4) / 4))
    assert np.isclose(out[-1], 1) and np.abs(out[values <= 8]).max() <= 1 / t * (1 + 1e-9)
    assert (np.diff(out[values >= 8]) > 0).all()
