from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from helpers import HAS_TABLES, awkward, docs, table

from presspulse.llm import decontaminate as D
from presspulse.llm.decontaminate import contaminations, drop_contaminated


def bags(ws):
    if len(ws) < 5:
        return collections.Counter([tuple(ws)])
    return collections.Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))


def plain(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def brute(texts, items):
    """Best similarity of each pair with a window of the item's length."""
    out = {}
    for d, t in texts:
        w = plain(t)
        for i, item in items:
            q = plain(item)
            if not q or not w:
                continue
            b = bags(q)
            n = sum(b.values())
            best = 0.0
            for s in range(max(1, len(w) - len(q) + 1)):
                a = bags(w[s : s + len(q)])
                common = sum((a & b).values())
                best = max(best, common / (sum(a.values()) + n - common))
            if best >= 0.8 - 1e-12:
                out[d, i] = round(best, 9)
    return out


def planted(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = [(i, " ".join(word() for _ in range(rng.randrange(15, 50)))) for i in range(12)] + [(20, "two words"), (21, "")]
    texts = []
    for d in range(60):
        w = [word() for _ in range(rng.randrange(5, 120))]
        q = items[rng.randrange(12)][1].split()
        kind = d % 6
        if kind == 1:
            w[len(w) // 2 : len(w) // 2] = q
        elif kind == 2:
            w[3:3] = q[1:] + [word()]
        elif kind == 3:
            w = q[: len(q) - 2]
        elif kind == 4:
            q[len(q) // 2] = word()
            w[1:1] = q
        elif kind == 5:
            w[2:2] = [x.upper() + "," for x in q]
        texts.append((d, " ".join(w)))
    return [*texts, (100, "here are Two, WORDS alone")], items


def test_equals_all_windows(spark):
    texts, items = planted()
    got = contaminations(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(texts, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got.collect()} == want
    assert len(want) > 30 and (100, 20) in want


@pytest.mark.skipif(not HAS_TABLES, reason="test tables are not there")
def test_tables(spark):
    rows, items = table(spark, "documents"), table(spark, "benchmark")
    got = {(r.doc_id, r.item_id) for r in contaminations(rows, items).collect()}
    assert got == set(brute([(r.doc_id, r.text) for r in rows.collect()], [(r.item_id, r.text) for r in items.collect()]))


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "same words here again and so on"), (3, "same words here again and so on"), (None, "x y z x y z x")], "item_id long, text string")
    got = contaminations(docs(spark, awkward()), items)
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert (6, 3) in pairs and {d for d, _ in pairs} == {5, 6} and got.count() == 2
    left = drop_contaminated(docs(spark, awkward()), items)
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 0, 1, 2, 3, 4]
    assert left.columns == docs(spark, []).columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminations(docs(spark, []), none).count() == 0
    assert contaminations(docs(spark, awkward()), none).count() == 0
    assert drop_contaminated(docs(spark, awkward()), none).count() == 9


def test_documents_without_an_id(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta")], "item_id long, text string")
    held = "here alpha beta gamma delta epsilon zeta eta there"
    rows = docs(spark, [(None, held), (None, "clean text of no id"), (None, None), (7, held), (8, "clean")])
    assert sorted((r.doc_id is None, r.item_id) for r in contaminations(rows, items).collect()) == [(False, 1), (True, 1)]
    assert sorted((r.text or "") for r in drop_contaminated(rows, items).collect()) == ["", "clean", "clean text of no id"]


def test_rarest_shingles_meet(spark):
    rng = np.random.default_rng(5)
    rank = rng.integers(0, 4, 1 << D.RANK_BITS).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        b = rng.integers(0, 25, n).astype(np.uint64)  # repeats are common
        a = np.concatenate([b[rng.random(n) < 0.93], rng.integers(0, 25, int(rng.integers(0, 3))).astype(np.uint64)])
        common = sum((collections.Counter(a.tolist()) & collections.Counter(b.tolist())).values())
        if not len(a) or len(a) > n or common < D.SIMILARITY * (len(a) + n - common) - 1e-12:
            continue
        shortest = int(np.ceil(D.SIMILARITY * n - 1e-9))
        left = D.rarest(a[None], rank, len(a) - D.common_least(len(a), n) + 1)[0]
        right = D.rarest(b[None], rank, n - D.common_least(shortest, n) + 1)[0]
        assert set(left.tolist()) & set(right.tolist())


def test_many_items_of_one_length_are_no_all_pairs(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    same = "which of the following is the best answer to it".split()
    items = [(i, " ".join(same + [word() for _ in range(20)])) for i in range(5000)]
    texts = [(d, " ".join([word() for _ in range(30)] + items[d * 7][1].split() + [word() for _ in range(30)])) for d in range(300)]
    counted = []
    real = D.candidates
    monkeypatch.setattr(D, "candidates", lambda *a: (counted.append((a[0].count(), real(*a).count())), real(*a))[1])
    got = contaminations(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(d, d * 7) for d in range(300)}
    ((windows, pairs),) = counted
    assert windows >= 300 and pairs <= 2 * windows  # all pairs are 5,000 a window
