from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import HAS_TABLES, awkward, docs, table

from presspulse.llm import near_dedup
from presspulse.llm.components import components
from presspulse.llm.near_dedup import bag_cells, keep_one, near_duplicate_classes, signatures
from presspulse.llm.tokens import shingles, words


def brute(texts):
    """Class of each id by comparing all pairs."""
    ids = [i for i, _ in texts]
    bag = shingles(words(pa.array([t for _, t in texts], pa.string())))
    bags = [collections.Counter(bag.hash[bag.doc == i].tolist()) for i in range(len(texts))]
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = sum((bags[a] & bags[b]).values())
            if common and common >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - common) - 1e-9:
                x, y = top(ids[a]), top(ids[b])
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def family(n, seed, length=120, edits=3):
    """Copies of one text with up to ``edits`` words changed, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    original = [word() for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(original)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(length)] = word()
        out.append(" ".join(w))
    return out + [" ".join(word() for _ in range(length)) for _ in range(n // 4)]


def classes(df):
    return {r.doc_id: r.class_id for r in df.collect()}


@pytest.mark.skipif(not HAS_TABLES, reason="test tables are not there")
def test_classes_equal_all_pairs(spark):
    rows = table(spark, "documents")
    assert classes(near_duplicate_classes(rows)) == brute([(r.doc_id, r.text) for r in rows.collect()])


def test_a_family_of_near_copies(spark, monkeypatch):
    texts = list(enumerate(family(60, 5, edits=6)))
    want = brute(texts)
    assert classes(near_duplicate_classes(docs(spark, texts))) == want
    # large buckets take the block comparison; small blocks, so that there are several
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 3)
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 16)
    assert classes(near_duplicate_classes(docs(spark, texts))) == want


def test_awkward_rows(spark):
    got = near_duplicate_classes(docs(spark, awkward()))
    assert got.columns == ["doc_id", "class_id"] and got.count() == 9
    assert all(r.class_id == r.doc_id for r in got.collect())
    left = keep_one(docs(spark, awkward()))
    assert left.columns == docs(spark, []).columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 0, 1, 2, 3, 4, 5, 6]


def test_empty_table(spark):
    assert near_duplicate_classes(docs(spark, [])).count() == 0
    assert keep_one(docs(spark, [])).count() == 0


def test_signature_agreement_is_the_weighted_similarity():
    rng = random.Random(3)
    base = [f"w{rng.randrange(40)}" for _ in range(400)]
    other = base[:300] + [f"v{i}" for i in range(100)]
    bag = shingles(words(pa.array([" ".join(base), " ".join(other), " ".join(base)])))
    sig = signatures(bag.doc, bag_cells(bag.doc, bag.hash), 3, 2000)
    a, b = (collections.Counter(bag.hash[bag.doc == i].tolist()) for i in (0, 1))
    common = sum((a & b).values())
    exact = common / (sum(a.values()) + sum(b.values()) - common)
    assert (sig[0] == sig[2]).all()
    assert abs((sig[0] == sig[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / 2000)


def test_signature_of_short_and_long_texts_is_complete():
    bag = shingles(words(pa.array(["one", "a b c d e f", "z " * 5000, ""])))
    sig = signatures(bag.doc, bag_cells(bag.doc, bag.hash), 4)
    empty = np.uint64((1 << 64) - 1)
    assert not (sig[:3] == empty).any() and (sig[3] == empty).all()


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(5, 5)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_with_several_texts_is_one_document(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = lambda t: t + " end"
    # 5 has two texts: one near 7, the other near 3 and equal to a text of 9; 8 and 2 share no text with it
    rows = [(5, a), (5, b), (7, near(a)), (3, near(b)), (9, b), (9, c), (8, "x y z x y z"), (2, near(c) + " here")]
    got = collections.defaultdict(set)
    for r in near_duplicate_classes(docs(spark, rows)).collect():
        got[r.doc_id].add(r.class_id)
    assert got == {2: {2}, 3: {2}, 5: {2}, 7: {2}, 9: {2}, 8: {8}}
