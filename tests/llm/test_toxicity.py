from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from helpers import HAS_TABLES, LABELS, awkward, docs, table

from presspulse.llm.toxicity import CATEGORIES, CATEGORY_WORDS, FOLDS, Model, drop_toxic, features, fit_chain, labelled_sample, score_toxicity, train


def labelled(spark, n=300, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    texts, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = rng.choices(words, k=60)
        if toxic:  # some with stems that no list holds
            w[:3] = rng.sample(["idiot", "moron", "scum", "trash"], 3) if i % 10 else ["zorkum", "zorkumab", "zorkel"]
        rng.shuffle(w)
        texts.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, 1, int(toxic), 0))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = labelled(spark)
    got = score_toxicity(docs(spark, texts), spark.createDataFrame(labels, LABELS)).toPandas().set_index("doc_id")
    unseen = [i for i, _ in texts if i % 3 == 0]
    truth = np.array([i % 5 == 0 for i in unseen])
    assert (got.toxic[unseen].to_numpy() == truth).mean() > 0.97
    named = [i for i in unseen if i % 5 == 0 and i % 10]
    assert got.insult[named].mean() > 0.5 > got.insult[[i for i in unseen if i % 5]].mean()


def test_rejected_documents_go(spark):
    texts, labels = labelled(spark)
    rows = docs(spark, texts + awkward()[:4])
    left = drop_toxic(rows, spark.createDataFrame(labels, LABELS))
    assert left.columns == rows.columns
    ids = {r.doc_id for r in left.collect()}
    assert len(ids & set(range(0, 300, 5))) <= 3 and len(ids & (set(range(300)) - set(range(0, 300, 5)))) >= 235


def test_later_links_use_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (300, 6)).astype(float)
    noise = rng.integers(0, 2, 300).astype(float)  # cannot be learned
    links, out = fit_chain(x, {"a": noise, "b": x[:, 0], "c": x[:, 1]}, np.arange(300) % FOLDS)
    assert [len(w) for w in links.values()] == [7, 8, 9]
    assert abs(np.corrcoef(out[:, 0], noise)[0, 1]) < 0.25  # in-fold fits would follow the noise
    assert (np.round(out[:, 1]) == x[:, 0]).all()


def test_model_reads_whole_texts():
    model = Model(["bad", "zor*"], {"toxic": np.array([5.0, 5.0, -2.0])})
    p = model.probabilities(pd.Series([None, "", "x " * 50_000 + "BAD", "zorkum", "badly"])).toxic
    assert (p > 0.5).tolist() == [False, False, True, True, False]


def test_awkward_rows(spark):
    rows = docs(spark, awkward())
    none = spark.createDataFrame([], LABELS)
    got = score_toxicity(rows, none).collect()
    assert len(got) == 9 and not any(r.toxic for r in got) and all(r.toxic_probability is None for r in got)
    assert drop_toxic(rows, none).count() == 9 and drop_toxic(docs(spark, []), none).count() == 0
    odd = spark.createDataFrame([(1, None, None, 0), (None, 1, 1, 0), (2, 1, 0, 0), (2, 0, 1, 0), (4, 1, 7, 0), (6, 1, 0, 0)], LABELS)
    assert score_toxicity(rows, odd).count() == 9


@pytest.mark.skipif(not HAS_TABLES, reason="test tables are not there")
def test_tables(spark):
    got = score_toxicity(table(spark, "documents"), table(spark, "labels")).toPandas()
    both = got.merge(table(spark, "labels").toPandas(), on="doc_id", suffixes=("", "_label"))
    assert (both.toxic == (both.toxic_label == 1)).mean() > 0.95
    assert got[list(CATEGORIES[:2])].notna().all().any()


def test_training_rows_are_bounded_and_copies_share_a_fold(spark):
    texts, labels = labelled(spark)
    rows = docs(spark, texts + texts[:40] * 5)  # repeated rows of an id are one training row
    sample = labelled_sample(rows, spark.createDataFrame(labels, LABELS), 60)
    assert sample.count() == len({r.doc_id for r in sample.collect()}) == 60
    every = spark.createDataFrame(labels, LABELS)
    once = score_toxicity(docs(spark, texts), every).toPandas().set_index("doc_id")
    again = score_toxicity(rows, every).dropDuplicates(["doc_id"]).toPandas().set_index("doc_id")
    assert np.allclose(once.toxic_probability, again.toxic_probability[once.index])


def test_scores_equal_a_plain_chain(spark):
    texts, labels = labelled(spark, 150)
    model = train(docs(spark, texts), spark.createDataFrame(labels, LABELS))
    text, toxic = dict(texts), {i: t for i, _, t, _ in labels}
    ids = sorted(toxic)
    words = {i: features(text[i]) for i in ids}
    order = sorted(model.at, key=model.at.get)
    x = np.array([[f in words[i] for f in order] for i in ids], float)
    fold = np.array([r.f for r in docs(spark, [(i, text[i]) for i in ids]).selectExpr("doc_id", f"pmod(xxhash64(text), {FOLDS}) f").orderBy("doc_id").collect()])
    y = np.array([toxic[i] for i in ids], float)
    has = {c: np.array([any(w in text[i].split() for w in ws) for i in ids]) for c, ws in CATEGORY_WORDS.items()}
    hidden = (y == 1) & ~(has["insult"] | has["contempt"])
    inputs = x
    for name, target in [*((c, np.where(hidden, np.nan, h & (y == 1))) for c, h in has.items()), ("toxic", y)]:
        known = ~np.isnan(target)

        def fitted(rows):
            a, b = np.hstack([inputs[rows], np.ones((rows.sum(), 1))]), target[rows]
            w, ridge = np.zeros(a.shape[1]), np.r_[np.full(a.shape[1] - 1, 0.1), 1e-6]
            for _ in range(40):  # Newton steps of the penalised likelihood
                p = 1 / (1 + np.exp(-a @ w))
                w = w + np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(ridge), a.T @ (b - p) - ridge * w)
            return w

        shift = np.log(sum(y) / sum(1 - y)) - np.log(sum(y) / sum(1 - y))  # the sample is all labels
        assert np.allclose(model.links[name], fitted(known) + np.r_[np.zeros(inputs.shape[1]), shift], atol=1e-3)
        out = np.zeros(len(ids))
        for f in range(FOLDS):
            w = fitted(known & (fold != f))
            out[fold == f] = 1 / (1 + np.exp(-(inputs[fold == f] @ w[:-1] + w[-1])))
        inputs = np.hstack([inputs, out[:, None]])
