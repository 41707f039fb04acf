"""Near-duplicate classes by DartMinHash signatures, banded joins and exact verification.

Documents are bags of word shingles; the weight of a shingle is how often it occurs. Two documents are
linked if their weighted Jaccard similarity is at least 0.8, and classes are the connected components.

Signature. Each shingle owns a half-plane of (weight, rank), cut into unit cells; weights are whole
numbers, so a document covers whole cells. Hashing a cell gives its Poisson(1) darts, and hashing a
dart gives its rank and its coordinate among ``k``. A document keeps the darts below its weights and
below the rank limit ``t / total weight``, with ``t = k ln k + 2 k``, and of each coordinate the dart of
least rank; where a coordinate got none, the limit is doubled. Work is ``O(t + words)`` a document
whatever ``k`` is, and two documents agree in a coordinate with the probability of their similarity.

Candidates share all coordinates of one of ``BANDS`` bands (a pair at 0.8 is missed with probability
5e-6). Documents with equal bags are one node. Each band bucket first links its members to its
smallest member only. After verification, buckets that still hold several components are looked at
again, so that each candidate pair is either compared or connected already. Small ones give the pairs
across components, at most ``SMALL_BUCKET / 2`` a member. Large ones are joined to families that are dealt
into blocks of bounded size; a task compares two blocks with matrix products and returns only links that
join components, fewer than it has documents. This work is quadratic in a family whose members stayed
apart, in arithmetic and not in rows.

Defined results: documents without a word, or with a null id, link to nothing; rows of one id are one
document, which is linked if any of its texts is; ties take the smallest id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presspulse.llm.components import components
from presspulse.llm.tokens import BASE, SIMILARITY, U, mix, shingles, text_slices, weighted_jaccard, words
from presspulse.sources.storage import cut_lineage

BANDS, ROWS = 40, 6
SMALL_BUCKET = 32
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000
COORDINATES = BANDS * ROWS
# Ranks are fixed-point numbers with this many bits after the point, in RANK_BITS altogether.
RANK_POINT, RANK_BITS = 33, 47
CELLS_AT_ONCE = 1 << 19
# Number of Poisson(1) darts of a cell by its uniform 32-bit hash.
POISSON = np.floor(np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)])) * 2.0**32).astype(np.int64)


def bag_cells(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One unit of weight of each occurrence: the shingle with its number among equal ones of its text."""
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    number = np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
    cells = np.empty(len(d), U)
    cells[order] = mix(h + number.astype(U) * U(BASE))
    return cells


def _throw(doc: np.ndarray, cells: np.ndarray, limit: np.ndarray, k: int, out: np.ndarray) -> None:
    """Lower ``out[doc, coordinate]`` to the least rank of the darts below each document's limit."""
    layers = np.ceil(limit).astype(np.int64)[doc]
    layer = np.arange(layers.sum()) - np.repeat(np.cumsum(layers) - layers, layers)
    d = np.repeat(doc, layers)
    cell = mix(np.repeat(cells, layers) ^ mix(layer.astype(U) * U(BASE) + U(1)))
    darts = np.searchsorted(POISSON, (cell >> U(32)).astype(np.int64), side="right")
    number = np.arange(darts.sum()) - np.repeat(np.cumsum(darts) - darts, darts)
    dart = mix(np.repeat(cell, darts) + (number + 1).astype(U) * U(BASE))
    d = np.repeat(d, darts)
    rank = (np.repeat(layer, darts).astype(U) << U(RANK_POINT)) | (dart >> U(64 - RANK_POINT))
    held = rank < np.minimum(limit * 2.0**RANK_POINT, 2.0**RANK_BITS - 1).astype(U)[d]
    d, rank, dart = d[held], rank[held], dart[held]
    key = ((d * k).astype(U) + (dart & U(0x7FFFFFFF)) % U(k)) << U(RANK_BITS) | rank
    key.sort()
    slot = (key >> U(RANK_BITS)).astype(np.int64)
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]
    flat = out.reshape(-1)
    flat[slot[first]] = np.minimum(flat[slot[first]], key[first] & U((1 << RANK_BITS) - 1))


def signatures(doc: np.ndarray, cells: np.ndarray, docs: int, k: int = COORDINATES) -> np.ndarray:
    """Least ranks, ``docs`` x ``k``. ``doc`` ascends; documents without a cell keep the largest number."""
    empty = U((1 << 64) - 1)
    out = np.full((docs, k), empty, U)
    weight = np.bincount(doc, minlength=docs)
    darts = k * np.log(k) + 2 * k
    limit = darts / np.maximum(weight, 1)
    todo = np.flatnonzero(weight)
    bounds = np.searchsorted(doc, np.arange(docs + 1))
    while len(todo):
        cost = np.cumsum(np.ceil(limit[todo]) * weight[todo])
        begin = 0
        while begin < len(todo):
            end = max(begin + 1, int(np.searchsorted(cost, (cost[begin - 1] if begin else 0) + CELLS_AT_ONCE, side="right")))
            some = todo[begin:end]
            at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in some])
            part = np.full((len(some), k), empty, U)
            _throw(np.repeat(np.arange(len(some)), weight[some]), cells[at], limit[some], k, part)
            out[some] = part
            begin = end
        todo = todo[(out[todo] == empty).any(axis=1)]
        limit[todo] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash for each band of each document."""
    docs, k = signature.shape
    rows = signature.reshape(docs, bands, k // bands)
    keys = np.repeat(np.arange(1, bands + 1, dtype=U)[None, :] * U(BASE), docs, axis=0)
    for r in range(k // bands):
        keys = mix(keys + rows[:, :, r])
    return keys


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole):
            bag = shingles(words(batch["text"]))
            cells = bag_cells(bag.doc, bag.hash)
            n = len(bag.count)
            sums = np.zeros((2, n), U)
            for i in (0, 1):  # sums of hashes of the occurrences: equal for equal bags
                np.add.at(sums[i], bag.doc, mix(cells + U(i + 7)))
            keys = band_keys(signatures(bag.doc, cells, n))
            keys[bag.count == 0] = 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].cast(pa.int64()),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.array(bag.count.astype(np.int64)),
                    pa.ListArray.from_arrays(np.arange(0, BANDS * n + 1, BANDS, dtype=np.int32), keys.reshape(-1).view(np.int64)),
                ],
                names=["doc_id", "bag1", "bag2", "n", "bands"],
            )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole, "text_a", 1 << 19):
            sides = [shingles(words(batch[c])) for c in ("text_a", "text_b")]
            ends = [np.cumsum(s.count) for s in sides]
            bag = lambda s, i: sides[s].hash[ends[s][i] - sides[s].count[i] : ends[s][i]]
            linked = [i for i in range(batch.num_rows) if weighted_jaccard(bag(0, i), bag(1, i)) >= SIMILARITY]
            yield pa.RecordBatch.from_arrays([batch[c].take(pa.array(linked, pa.int64())) for c in ("a", "b")], names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of document ids whose texts are similar enough."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def _similar(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Index pairs of the bags, as arrays of cells, that are similar enough."""
    flat = lambda bags: (np.concatenate([*bags, np.zeros(0, U)]), np.repeat(np.arange(len(bags)), [len(x) for x in bags]))
    (xa, da), (xb, db) = flat(a), flat(b)
    both = np.intersect1d(xa, xb)
    common = np.zeros((len(a), len(b)), np.float32)
    held_a, held_b = np.isin(xa, both), np.isin(xb, both)
    ia, da, ib, db = np.searchsorted(both, xa[held_a]), da[held_a], np.searchsorted(both, xb[held_b]), db[held_b]
    for at in range(0, len(both), 2048):
        left, right = np.zeros((len(a), 2048), np.float32), np.zeros((len(b), 2048), np.float32)
        some = (ia >= at) & (ia < at + 2048)
        left[da[some], ia[some] - at] = 1
        some = (ib >= at) & (ib < at + 2048)
        right[db[some], ib[some] - at] = 1
        common += left @ right.T
    total = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :]
    return np.argwhere(common >= SIMILARITY * (total - common) * (1 - 1e-9))


def _compare_blocks(group: pa.Table) -> pa.Table:
    """Links that join components within the two blocks of a group."""
    group = group.combine_chunks()
    bag = shingles(words(group["text"].combine_chunks()))
    cells, ends = bag_cells(bag.doc, bag.hash), np.cumsum(bag.count)
    bags = [cells[e - n : e] for e, n in zip(ends, bag.count, strict=True)]
    block, node, part = (group[c].to_numpy() for c in ("block", "node", "part"))
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    rows, columns = np.flatnonzero(block == low), np.flatnonzero(block == high)
    found = _similar([bags[i] for i in rows], [bags[i] for i in columns])
    i, j = rows[found[:, 0]], columns[found[:, 1]]
    up = {p: p for p in part.tolist()}

    def top(p: int) -> int:
        while up[p] != p:
            up[p] = up[up[p]]
            p = up[p]
        return p

    links = []
    for x in np.flatnonzero(part[i] != part[j]):
        p, q = top(int(part[i[x]])), top(int(part[j[x]]))
        if p != q:
            up[p] = q
            links.append(x)
    return pa.table({"a": np.minimum(node[i[links]], node[j[links]]), "b": np.maximum(node[i[links]], node[j[links]])})


def linked_in_blocks(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``(a, b)`` across the components of ``members(bucket, node, n, part)`` within families."""
    hubs = members.groupBy("bucket").agg(F.min("node").alias("a"))
    family = components(members.join(hubs, "bucket").select("a", F.col("node").alias("b")).distinct())
    once = members.select("node", "n", "part").distinct().join(family, "node")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    dealt = once.join(once.groupBy("component").agg(blocks), "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    met = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    met = met.select("component", "node", "part", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    whole = met.join(texts.select(F.col("doc_id").alias("node"), "text"), "node")
    return whole.groupBy("component", "low", "high").applyInArrow(_compare_blocks, "a long, b long")


def of_one_id(known: DataFrame, heads: DataFrame) -> DataFrame:
    """Links between the nodes of the different texts of one id."""
    several = known.groupBy("doc_id").agg(F.min("bag1").alias("p"), F.max("bag1").alias("q")).where("p < q").select("doc_id")
    nodes = known.join(several, "doc_id", "left_semi").join(heads, ["bag1", "bag2"]).select("doc_id", "rep")
    return nodes.join(nodes.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct()


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, class_id)`` for each row of ``docs(doc_id, text)``; ``class_id`` is the class's smallest id."""
    docs = docs.select("doc_id", "text")
    signed = cut_lineage(docs.mapInArrow(_sign, "doc_id long, bag1 long, bag2 long, n long, bands array<long>"))
    known = signed.where("n > 0 and doc_id is not null")
    heads = known.groupBy("bag1", "bag2").agg(F.min("doc_id").alias("rep"))
    # one row per different bag
    nodes = known.join(heads, [known.bag1 == heads.bag1, known.bag2 == heads.bag2, known.doc_id == heads.rep], "left_semi")
    members = nodes.select(F.col("doc_id").alias("node"), "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    bucketed = cut_lineage(members.join(shared.drop("last"), "bucket"))
    fits = lambda a, b: F.least(a, b) >= SIMILARITY * F.greatest(a, b)  # noqa: E731  else the similarity is lower
    stars = cut_lineage(bucketed.where(F.col("node") != F.col("hub")).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    involved = bucketed.select(F.col("node").alias("doc_id")).distinct()
    texts = docs.join(involved, "doc_id", "left_semi").withColumn("same", F.xxhash64("text"))
    texts = cut_lineage(texts.dropDuplicates(["doc_id", "same"]).drop("same"))
    links = cut_lineage(verified(stars, texts).unionAll(of_one_id(known, heads)))
    classes = components(links)

    # what the smallest members did not connect: members of a bucket in different components
    placed = bucketed.join(classes, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("part"))
    split = placed.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("size")).where("p < q")
    open_rows = cut_lineage(placed.join(split.select("bucket", "size"), "bucket"))
    small, large = open_rows.where(F.col("size") <= SMALL_BUCKET), open_rows.where(F.col("size") > SMALL_BUCKET)
    x, y = small.alias("x"), small.alias("y")
    across = (
        x.join(y, F.expr("x.bucket = y.bucket and x.node < y.node and x.part <> y.part"))
        .where(fits("x.n", "y.n"))
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    links = links.unionAll(cut_lineage(verified(across, texts))).unionAll(cut_lineage(linked_in_blocks(large, texts)))
    classes = components(links)
    of_rep = heads.join(classes, heads.rep == classes.node, "left")
    of_rep = of_rep.select("bag1", "bag2", F.coalesce("component", "rep").alias("class_id"), F.lit(True).alias("worded"))
    worded = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.lit(True))
    return (
        signed.select("doc_id", "bag1", "bag2", worded.alias("worded"))
        .join(of_rep, ["bag1", "bag2", "worded"], "left")
        .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: that of the smallest id, and one row of it.

    Documents with a null id all stay.
    """
    gone = near_duplicate_classes(docs).where("class_id <> doc_id").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    if again.isEmpty():
        return left
    once = left.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionAll(once)
