from __future__ import annotations

import collections
import functools
import math
import random

import pyarrow as pa
import pytest
from helpers import LABELS, awkward, docs

from presspulse.llm.ngram_quality import ORDER, QUANTILE, Model, _add_up, _count, grams, perplexity_quality, trusted


def text(rng, n=60):
    return " ".join(rng.choice(["the", "of", "and", "river", "stone", "light", "runs", "über"]) for _ in range(n)) + "."


def tables(spark, n=120):
    rng = random.Random(9)
    rows = [(i, text(rng) if i % 6 else "".join(rng.choices("#%&QXZ019", k=300))) for i in range(n)] + awkward("the of " * 20_000)
    rows = [(1000 + i if k >= n and i is not None else i, t) for k, (i, t) in enumerate(rows)]
    labels = [(i, int(i % 6 > 0), 0, 1) for i in range(n) if i % 2]
    return docs(spark, rows), spark.createDataFrame(labels, LABELS), rows


def brute(training):
    """Interpolated modified Kneser-Ney probabilities, straight from the definition."""
    counts = {ORDER: collections.Counter()}
    for t in training:
        padded = b"\0" * (ORDER - 1) + t
        counts[ORDER].update(padded[i : i + ORDER] for i in range(len(t)))
    for k in range(ORDER - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    discount, contexts = {}, {}
    for k, table in counts.items():
        n = collections.Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        discount[k] = [0.0] + [min(max(d, 0.0), float(i)) for i, d in enumerate(raw, 1)]
        contexts[k] = collections.defaultdict(lambda: [0, 0, 0, 0])
        for g, v in table.items():
            held = contexts[k][g[:-1]]
            held[0] += v
            held[min(v, 3)] += 1

    @functools.lru_cache(None)
    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / 256
        if g[:-1] not in contexts[k]:
            return low
        total, *n = contexts[k][g[:-1]]
        v, d = counts[k][g], discount[k]
        return (v - d[min(v, 3)] + sum(a * b for a, b in zip(d[1:], n, strict=True)) * low) / total

    return p


def test_perplexities_and_verdicts(spark):
    rows, labels, plain = tables(spark)
    held = {r.doc_id: r.held for r in trusted(rows, labels).collect()}
    assert 0 < sum(held.values()) < len(held)
    p = brute([t.encode() for i, t in plain if held.get(i) is False])
    assert sum(p(b"rive" + bytes([c])) for c in range(256)) == pytest.approx(1.0)
    got = perplexity_quality(rows, labels).collect()
    assert len(got) == len(plain)
    want = collections.Counter()
    for i, t in plain:
        data = (t or "").encode()
        padded = b"\0" * (ORDER - 1) + data
        logs = [math.log(p(padded[k : k + ORDER])) for k in range(len(data))]
        want[i, len(data), round(math.exp(-sum(logs) / len(data)), 6) if data else None] += 1
    assert collections.Counter((r.doc_id, r.n_bytes, None if r.perplexity is None else round(r.perplexity, 6)) for r in got) == want
    limit = max(r.perplexity for r in got if held.get(r.doc_id))
    for r in got:
        assert r.threshold <= limit + 1e-9
        assert r.kept == (r.perplexity is not None and r.perplexity <= r.threshold)
    known = [r for r in got if r.doc_id is not None and r.doc_id < 120]
    assert not any(r.kept for r in known if r.doc_id % 6 == 0)
    assert sum(not r.kept for r in known if r.doc_id % 6) <= 5  # few held-out documents: their largest is the limit


def test_empty_and_unlabelled_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert perplexity_quality(docs(spark, []), none).count() == 0
    got = perplexity_quality(docs(spark, [(1, "a"), (2, None)]), none).collect()
    assert {(r.doc_id, r.kept, r.threshold) for r in got} == {(1, True, None), (2, False, None)}
    assert {round(r.perplexity, 6) for r in got if r.perplexity} == {256.0}


def test_counts_of_shards_add_up():
    texts = pa.array(["abcabc", None, "", "éa" * 50])
    keys, offsets = grams(texts)
    assert offsets.tolist() == [0, 6, 6, 6, 156] and keys[0] == ord("a") and keys[2] == int.from_bytes(b"abc", "big")
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = pa.Table.from_batches([*_count(iter([batch]), 100), *_count(iter([batch]), 100)])
    total = collections.Counter()
    for shard in set(parts["shard"].to_pylist()):
        group = parts.filter(pa.compute.equal(parts["shard"], shard))
        total.update(dict(zip(*[c.to_pylist() for c in _add_up(group).columns], strict=True)))
    assert total == {k: 2 * v for k, v in collections.Counter(keys.tolist()).items()}
    assert Model.__doc__


def test_threshold_is_the_quantile_of_enough_held_out_documents(spark):
    from presspulse.llm.ngram_quality import _threshold

    for n in (1, 7, 99, 100, 200):  # the same rule at every size
        rows = spark.range(1, n + 1).selectExpr("cast(id as double) perplexity")
        assert rows.agg(_threshold()).first()[0] == math.ceil(n * QUANTILE)
