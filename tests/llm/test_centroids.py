from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presspulse.llm.centroids import clusters, nearest, vantage_tree

from helpers import HAS_TABLES, table

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, n int, vector int"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "d", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k, rounds, dims):
    """Plain Lloyd rounds with whole numbers of any size."""
    kept = [(i, [math.floor(64 * x) for x in np.array(v, np.float32).tolist()]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    points = [x for _, x in sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))[:k]]
    gap = lambda x, p: sum((a - b) ** 2 for a, b in zip(x, p, strict=True))
    place = lambda x: min((gap(x, p), j) for j, p in enumerate(points))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(place(x)[1], []).append(x)
        for j, xs in groups.items():
            points[j] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    final = [(i, *place(x)) for i, x in kept]
    total = sum(d for _, d, _ in final)
    own = {j: sum(d for _, d, c in final if c == j) for j in range(len(points))}
    return [(i, j, d, own[j], total, sha(",".join(map(str, points[j])))) for i, d, j in final]


def same(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


POINT = st.lists(st.integers(-3, 3), min_size=2, max_size=2)


@given(st.lists(POINT, min_size=1, max_size=25), st.lists(POINT, min_size=1, max_size=20), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_search_finds_the_nearest_and_the_smallest_of_ties(points, vectors, leaf):
    p, v = np.array(points, np.int64), np.array(vectors, np.int64)
    which, best = nearest(vantage_tree(p, leaf), v)
    away = ((v[:, None, :] - p[None]) ** 2).sum(axis=2)
    assert which.tolist() == away.argmin(axis=1).tolist()
    assert best.tolist() == away.min(axis=1).tolist()


def test_search_with_numbers_near_the_limit():
    rng = np.random.default_rng(3)
    p = rng.integers(-(1 << 27) + 1, 1 << 27, (16, 64))
    p[5] = p[2]
    v = np.concatenate([p + rng.integers(-1, 2, p.shape), -p])
    which, best = nearest(vantage_tree(p), v)
    away = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y, strict=True)) for y in p] for x in v]
    assert which.tolist() == [min(range(16), key=lambda j: (row[j], j)) for row in away]
    assert best.tolist() == [min(row) for row in away]


def test_search_leaves_subtrees_out():
    p = np.array([[100 * i, 0] for i in range(64)], np.int64)
    tree = vantage_tree(p)
    looked = []
    near = [h for h in tree.held]
    which, _ = nearest(tree._replace(held=[_Seen(h, looked) for h in near]), p[:1])
    assert which.tolist() == [0]
    assert len(looked) < 32


class _Seen(list):
    def __init__(self, held, looked):
        super().__init__(held.tolist())
        self.looked = looked

    def __iter__(self):
        for c in super().__iter__():
            self.looked.append(c)
            yield c


def test_awkward_rows_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-40, 40, 4).astype(float) / 64) for i in range(60)]
    rows = [(i, v.tolist()) for i, v in rows]
    rows += [rows[0], rows[0], rows[3], (None, [0.1, 0.2, 0.3, 0.4]), (70, None), (71, []), (72, [1.0, 2.0, 3.0]), (73, [1.0, None, 2.0, 3.0])]
    rows += [(74, [1.0, math.nan, 2.0, 3.0]), (75, [1.0, math.inf, 2.0, 3.0]), (76, [-0.001, 0.0, 0.0, 1000.5]), (77, [1.0] * 5), (1, [0.0] * 4)]
    got = clusters(embeddings(spark, rows), k=5, dims=4).collect()
    same(got, brute(rows, 5, 3, 4))


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0])]
    same(clusters(embeddings(spark, rows), k=5, dims=2).collect(), brute(rows, 5, 3, 2))
    assert clusters(embeddings(spark, [(1, None)]), dims=2).collect() == []
    assert clusters(embeddings(spark, []), dims=2).collect() == []


def test_numbers_too_large_are_left_out(spark):
    rows = [(1, [1.0, 2.0]), (2, [3e6, 0.0])]
    assert [r["vec_id"] for r in clusters(embeddings(spark, rows), dims=2).collect()] == [1]


@pytest.mark.skipif(not HAS_TABLES, reason="needs the test tables")
def test_whole_table_against_brute_force(spark):
    data = table(spark, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in data.collect()]
    same(clusters(data).collect(), brute(rows, 16, 3, 64))
