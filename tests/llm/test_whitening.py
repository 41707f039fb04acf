from __future__ import annotations

import math

import numpy as np
import pytest

from presspulse.llm.whitening import Centre, deviations, factor, solve, whitened_rows

from helpers import HAS_TABLES, table

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, whitened int, vector int"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "n", 1, 2) for i, v in rows], SCHEMA)


def check(got, rows, components=32, tolerance=1e-7):
    """Compare with an eigendecomposition of the covariance of exact numbers."""
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * e) + 1_000_000 for e in np.array(v, np.float32).tolist()] for _, v in kept], object)
    n, total = len(x), x.sum(axis=0)
    gap = n * x - total
    deviation = (gap**2).sum(axis=1)
    centred = (gap / n).astype(float)
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    held = min(components, int((value > 1e-9 * value[0]).sum()))
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    assert sum(map(len, by.values())) == n * held
    column = np.zeros((n, held))
    seen = {}
    for j, (i, _) in enumerate(kept):
        mine = sorted(by[i], key=lambda r: (r["component"], r["deviation"]))
        copies = len(mine) // held
        at = seen[i] = seen.get(i, -1) + 1
        assert copies == sum(k == i for k, _ in kept)
        column[j] = [mine[c * copies + at]["whitened"] for c in range(held)]
        if copies == 1:
            assert {r["deviation"] for r in mine} == {deviation[j]}
    assert {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-8
    for r in got:
        assert r["explained"] == pytest.approx(value[r["component"] - 1] / np.trace(centred.T @ centred / n), rel=1e-6)
    assert np.abs(column.T @ column / n - np.eye(held)).max() < 1e-7
    want = centred @ vector[:, :held] / np.sqrt(value[:held])
    sign = np.sign((want * column).sum(axis=0))
    assert np.abs(want * sign - column).max() < tolerance * np.abs(want).max()


def test_rows_of_any_kind(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 6)) * [9, 5, 3, 1, 0.5, 0.1] + 7)]
    rows += [(400, None), (401, [None] * 6), (402, [math.nan] * 6), (403, [math.inf] * 6), (404, [])]
    check(whitened_rows(embeddings(spark, rows)).collect(), rows)


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 3)))]
    rows += [rows[3], rows[3], (None, [1.0, 2.0, 3.0])]
    check(whitened_rows(embeddings(spark, rows)).collect(), rows)


def test_dimensions_that_depend_on_each_other(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-500, 500, (200, 3)) / 64
    rows = [(i, [v[0], v[1], v[0], 5.0, v[2], v[0] + v[1]]) for i, v in enumerate(base.tolist())]
    check(whitened_rows(embeddings(spark, rows)).collect(), rows)


def test_ill_conditioned_rows(spark):
    rng = np.random.default_rng(8)
    common = rng.integers(-(1 << 23), 1 << 23, 400) / 64
    rows = [(i, [c + e[0], c + e[1], c]) for i, (c, e) in enumerate(zip(common.tolist(), (rng.integers(-2, 3, (400, 2)) / 64).tolist(), strict=True))]
    got = whitened_rows(embeddings(spark, rows)).collect()
    assert max(r["component"] for r in got) == 3
    # the least eigenvalue is 12 digits below the largest: an eigendecomposition of the covariance loses it
    assert max(r["identity_error"] for r in got) < 1e-6
    x = np.array([[math.floor(64 * e) for e in v] for _, v in rows], float)
    sigma = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    share = {r["component"]: r["explained"] for r in got}
    assert [share[c] for c in (1, 2, 3)] == pytest.approx((sigma**2 / (sigma**2).sum()).tolist(), rel=1e-6)


def test_less_than_two_different_vectors_give_nothing(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitened_rows(embeddings(spark, rows)).collect() == []


def test_other_lengths_are_left_out(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [4.0, 0.0]), (4, [1.0]), (5, [1.0, 2.0, 3.0])]
    assert {r["vec_id"] for r in whitened_rows(embeddings(spark, rows)).collect()} == {1, 2, 3}


def test_deviations_are_exact_or_null():
    rows = np.array([[3, -4], [1 << 30, 1], [1 << 40, 0]], np.int64)
    centre = Centre(7, np.zeros(2, np.int64), np.array([2, 5], object))
    want = [sum((7 * int(x) - r) ** 2 for x, r in zip(row, (2, 5), strict=True)) for row in rows]
    assert deviations(rows, centre).to_pylist() == [want[0], want[1] if want[1] < 1 << 63 else None, None]


def test_solve_and_factor():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(50, 5))
    r = factor(a.T @ a, shifted=False)
    q = solve(a, r)
    assert np.abs(q.T @ q - np.eye(5)).max() < 1e-12
    assert np.abs(q @ r - a).max() < 1e-12


@pytest.mark.skipif(not HAS_TABLES, reason="needs the test tables")
def test_whole_table(spark):
    data = table(spark, "embeddings")
    check(whitened_rows(data).collect(), [(r["vec_id"], r["embedding"]) for r in data.collect()])
