import math

import numpy as np
import pytest

from furlong.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x string, v string"


def vectors(count=300, width=24, seed=1, spread=None):
    random = np.random.default_rng(seed)
    values = random.standard_normal((count, width)) * (np.linspace(3, 0.5, width) if spread is None else spread)
    return [(i, [float(np.float32(c)) for c in row], 0, 7, "", "") for i, row in enumerate(values)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(rows):
    """Fit list, sums and covariance by whole numbers, then a dense eigensolver."""
    x = {i: tuple(math.floor(64 * c) + 1_000_000 for c in v) for i, (_, v, *_) in enumerate(rows)}
    different = sorted(set(x.values()))
    n, sums = len(different), [sum(column) for column in zip(*different)]
    far = np.array([[n * a - s for a, s in zip(row, sums)] for row in different], float) / n
    values, turn = np.linalg.eigh(far.T @ far / n)
    deviations = [sum((n * a - s) ** 2 for a, s in zip(x[i], sums)) for i in range(len(rows))]
    centred = np.array([[(n * a - s) / n for a, s in zip(x[i], sums)] for i in range(len(rows))])
    return n, values[::-1], turn[:, ::-1], deviations, centred


def check(found, rows, components):
    n, values, turn, deviations, centred = brute(rows)
    at = {row[0]: i for i, row in enumerate(rows)}
    table = {(r["vec_id"], r["component"]): r for r in found}
    assert set(table) == {(i, c) for i in at for c in range(1, components + 1)}
    for c in range(1, components + 1):
        expected = centred @ turn[:, c - 1] / np.sqrt(values[c - 1])
        own = np.array([table[row[0], c]["whitened"] for row in rows])
        own *= np.sign(own @ expected)
        assert np.abs(own - expected).max() < 1e-9
        (share,) = {r["explained"] for r in found if r["component"] == c}
        assert share == pytest.approx(values[c - 1] / values.sum(), rel=1e-12)
    assert [table[row[0], 1]["deviation"] for row in rows] == deviations
    assert {r["n"] for r in found} == {n} and {r["identity_error"] for r in found if r["identity_error"] > 1e-9} == set()


def test_against_a_dense_solver(spark):
    rows = vectors(width=40)
    rows += [(1000 + i, row[1], 0, 7, "", "") for i, row in enumerate(rows[:100])]  # copies count once in the fit
    check(whitening.whitened(frame(spark, rows), 16).collect(), rows, 16)


def test_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check(whitening.whitened(table, 16).collect(), rows, 16)


def test_narrow_vectors_and_those_without_variance(spark):
    rows = vectors(count=50, width=3)
    check(whitening.whitened(frame(spark, rows), 16).collect(), rows, 3)
    rows = [(i, [float(i), 2.0 * i, 5.0], 0, 7, "", "") for i in range(20)]
    found = whitening.whitened(frame(spark, rows), 16).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 20
    assert found[0]["explained"] == pytest.approx(1)


def test_rows_that_take_no_part(spark):
    rows = vectors(count=40, width=4)
    odd = [
        (100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, math.nan, 2.0, 3.0]), (104, [1.0, math.inf, 0.0, 0.0]),
        (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0, 0.0]),
    ]
    extra = [(i, v, 0, 7, "", "") for i, v in odd]
    check(whitening.whitened(frame(spark, rows + extra), 16).collect(), rows, 4)
    again = [(None, rows[0][1], 0, 7, "", ""), (3, rows[3][1], 0, 7, "", "")]
    found = whitening.whitened(frame(spark, rows + again), 2).collect()
    assert len(found) == 2 * 42 and sum(r["vec_id"] is None for r in found) == 2 and {r["n"] for r in found} == {40}


def test_one_vector_and_none(spark):
    one = vectors(count=1)
    assert whitening.whitened(frame(spark, one * 3), 16).collect() == []
    empty = whitening.whitened(frame(spark, []), 16)
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_large_deviations_are_exact_or_null():
    centre = whitening.Centre(10**9, [10**9 * 1_000_000 + 5, 3])
    x = np.array([[1_000_004, 0], [2**42, 1]])
    first, second = centre.deviations(x)
    assert first is None and second is None
    small = whitening.Centre(7, [7_000_004, 3])
    assert small.deviations(np.array([[1_000_003, 2], [2**28, 0]])) == [(21 - 4) ** 2 + (14 - 3) ** 2, (7 * 2**28 - 7_000_004) ** 2 + 9]


@pytest.mark.parametrize("gap", [1.0, 1e-3, 1e-9, 0.0])
def test_flat_spectra_converge(gap):
    random = np.random.default_rng(5)
    values = np.concatenate([1 + gap * np.linspace(1, 0.1, 20), np.linspace(0.999, 0.99, 60) if gap else np.ones(60)])
    turn = np.linalg.qr(random.standard_normal((80, 80)))[0]
    full = turn * values @ turn.T
    products = []

    def times(q):
        products.append(1)
        return full @ q

    found, vectors_ = whitening.leading(times, 80, 16)
    assert np.abs(found - np.sort(values)[::-1][:16]).max() < 1e-11
    assert np.abs(full @ vectors_ - vectors_ * found).max() < 1e-11 and np.abs(vectors_.T @ vectors_ - np.eye(16)).max() < 1e-12
    assert len(products) < 400
