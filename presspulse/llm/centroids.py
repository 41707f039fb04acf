"""Clusters of integer vectors by Lloyd rounds that search a vantage-point tree over the centroids.

Vectors become whole numbers, ``floor(scale * x)``; distances and centroids are exact. Each round builds a
vantage-point tree of the centroids on the driver and broadcasts it; its size is that of the centroids.
Every vector runs its own best-first branch and bound in it: the open subtree of least lower bound comes
next, and a subtree stays open while its bound does not exceed the distance of the nearest centroid so far,
the bound itself included, so that ties go to the smallest number. Bounds are floating-point and are lowered
by more than their error; distances at vantage points and leaves are whole numbers. The searches of a batch
advance together, step by step, as arrays.

A task adds up the vectors of each centroid and returns one row a centroid; only these sums are shuffled, and
the driver gets one row for each centroid and component. The last assignment is kept as a narrow
checkpoint, from which the sums of distances are taken.

Defined results: vectors of another length, or with a null, infinite or NaN component, are dropped, and so
are those with a component of ``LIMIT / scale`` or more, whose squared distances need not fit into 64
bits. Repeated rows count each; rows with a null id count, and come last among the possible first
centroids; fewer vectors than centroids give fewer centroids; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presspulse.llm.tokens import row_slices
from presspulse.sources.storage import cut_lineage

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
LIMIT = 1 << 27  # 64 squared differences of numbers below it fit into 63 bits
LEAF = 3
BATCH = 4096


class Tree(NamedTuple):
    """Vantage-point tree as arrays by node. A node holds its centroids ``held``: the vantage point alone,
    or all of a leaf. ``near`` and ``far`` bound the distances of an inner child's centroids to the vantage
    point of its parent."""

    points: np.ndarray
    held: list[np.ndarray]
    children: list[list[int]]
    near: np.ndarray
    far: np.ndarray


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = vectors - point
    return np.einsum("ij,ij->i", gap, gap)


def vantage_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of the given centroids. The vantage point is the one farthest from the first of its subtree;
    the others are cut at their median distance to it."""
    held, children, near, far = [], [], [], []

    def grow(members: np.ndarray, low: float, high: float) -> int:
        node = len(held)
        held.append(members)
        children.append([])
        near.append(low)
        far.append(high)
        if len(members) > leaf:
            top = int(np.argmax(squared(points[members], points[members[0]])))
            held[node], rest = members[top : top + 1], np.delete(members, top)
            away = np.sqrt(squared(points[rest], points[members[top]]).astype(float))
            order = np.argsort(away, kind="stable")
            for part in filter(len, np.array_split(order, 2)):
                children[node].append(grow(np.sort(rest[part]), float(away[part].min()), float(away[part].max())))
        return node

    if len(points):
        grow(np.arange(len(points)), 0.0, 0.0)
    return Tree(points, held, children, np.array(near), np.array(far))


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector; ties: the smallest number."""
    n = len(vectors)
    best, which = np.full(n, np.iinfo(np.int64).max), np.full(n, len(tree.points))
    bound = np.full((n, len(tree.held)), np.inf)  # of open subtrees
    bound[:, :1] = 0.0
    live = np.arange(n)
    while len(live):
        node = np.argmin(bound[live], axis=1)
        least = bound[live, node]
        going = least <= np.sqrt(best[live].astype(float))  # a bound equal to the best may hold a tie
        live, node, least = live[going], node[going], least[going]
        bound[live, node] = np.inf
        for k in np.unique(node):
            of = node == k
            rows = live[of]
            for c in tree.held[k]:
                away = squared(vectors[rows], tree.points[c])
                closer = (away < best[rows]) | ((away == best[rows]) & (c < which[rows]))
                best[rows[closer]], which[rows[closer]] = away[closer], c
            if tree.children[k]:
                root = np.sqrt(away.astype(float))  # of the vantage point, the only one held
                for child in tree.children[k]:
                    gap = np.maximum(tree.near[child] - root, root - tree.far[child])
                    gap -= 1e-9 * (root + tree.far[child])
                    bound[rows, child] = np.maximum(np.maximum(gap, least[of]), 0.0)
    return which, best


def usable(vector: str, dims: int, scale: int) -> F.Column:
    small = lambda x: x.isNotNull() & (F.abs(x) < LIMIT / scale)  # noqa: E731  NaN is larger than all numbers
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, small), F.lit(False))


def matrix(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(-1, dims)


def _sums(tree, dims: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.value.points)
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in row_slices(batches, BATCH):
            x = matrix(batch["vector"], dims, scale)
            which, _ = nearest(tree.value, x)
            np.add.at(total, which, x)
            count += np.bincount(which, minlength=k)
        seen = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(np.arange(0, dims * len(seen) + 1, dims, dtype=np.int32), total[seen].reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(count[seen]), lists], names=["cluster", "n", "total"])

    return add


def _assign(tree, dims: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, BATCH):
            which, best = nearest(tree.value, matrix(batch["vector"], dims, scale))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(which.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return assign


def first_centroids(kept: DataFrame, k: int, dims: int, scale: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes; a top-k of the scan."""
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.floor(np.array([r["vector"] for r in rows], np.float64).reshape(-1, dims) * scale).astype(np.int64)


def clusters(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """Cluster and squared distance of each usable vector of ``embeddings(vec_id, embedding)``, the sums of
    squared distances over its cluster and over all, and the checksum of its centroid."""
    spark = embeddings.sparkSession
    read = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    kept = read.where(usable("vector", dims, scale))
    points = first_centroids(kept, k, dims, scale)
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(vantage_tree(points))
        added = kept.select("vector").mapInArrow(_sums(tree, dims, scale), "cluster int, n long, total array<long>")
        cells = added.select("cluster", "n", F.posexplode("total").alias("dim", "part"))
        whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
        for r in cells.groupBy("cluster", "dim").agg(whole("part"), whole("n")).collect():  # k * dims rows
            points[r["cluster"], r["dim"]] = int(r["part"]) // int(r["n"])
        tree.unpersist()
    tree = spark.sparkContext.broadcast(vantage_tree(points))
    placed = cut_lineage(kept.mapInArrow(_assign(tree, dims, scale), "vec_id long, cluster int, distance long"))
    tree.unpersist()
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    names = [hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest() for p in points]
    # beyond 64 bits the sums are null
    fits = lambda n: F.lit(n if n < 1 << 63 else None).cast("long")
    table = F.array(*[F.struct(fits(inertia.get(i, 0)).alias("i"), F.lit(h).alias("h")) for i, h in enumerate(names)])
    own = F.get(table, F.col("cluster")) if names else F.lit(None).cast("struct<i:long,h:string>")
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        own["i"].alias("cluster_inertia"),
        fits(sum(inertia.values())).alias("inertia"),
        own["h"].alias("centroid_sha256"),
    )
