"""Toxicity by a chain of linear classifiers.

The chain predicts ``CATEGORIES`` in order. Each link is a logistic regression over the document's word
and word-prefix features and over the probabilities of the links before it. For training, those
probabilities are out-of-fold predictions, so a later link sees earlier ones as they are on new text.

The labels only tell toxic from not. The first two categories are therefore weakly labelled: among
toxic documents, by the words of ``CATEGORY_WORDS``; toxic documents with none of these words (such as
those in other languages) are left out of the links of these categories, not taken for negatives. The
last link, ``toxic``, has the real labels of all.

The training rows are a bounded sample: the ``SAMPLE_ROWS / 2`` labelled documents of either class that
come first by a hash of their id, one row of each. Only their features go to the driver, not their texts. Folds
go by a hash of the text, so that copies share one. The class shares of all labels correct the intercepts.

Defined results: null and empty texts get the probabilities of a text without features; with no label
of either class everything is non-toxic with null probabilities; label rows with null or other values
are ignored; of several labels for a document the largest holds; repeated document rows each get theirs,
and the first text by order is trained on; a category with fewer than ``2 * FOLDS`` weak positives has no link, and
null probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presspulse.sources.storage import cut_lineage

SAMPLE_ROWS = 4000
FEATURES = 400
FOLDS = 3
RIDGE = 0.1
THRESHOLD = 0.5
PREFIXES = (3, 4, 5, 6)
#: Words that name the weakly labelled categories.
CATEGORY_WORDS = {
    "insult": ("idiot", "moron", "clown", "loser", "stupid", "fool", "dumb"),
    "contempt": ("worthless", "pathetic", "disgusting", "trash", "scum", "vermin", "filth"),
}
CATEGORIES = (*CATEGORY_WORDS, "toxic")
ACTIVE = "doc_id long, toxic int, fold int, active array<int>, " + ", ".join(f"{c} boolean" for c in CATEGORY_WORDS)
WORD = re.compile(r"\w+")


def features(text: str | None) -> set[str]:
    """The words of a text, lower-cased, and their prefixes (ending in ``*``)."""
    found = set(WORD.findall((text or "").lower()))
    return found.union(*({w[:n] + "*" for w in found if len(w) >= n} for n in PREFIXES))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, text, toxic)`` of the training rows, one a document."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picked = [known.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2) for v in (0, 1)]
    # at most `rows` ids, whatever the tables
    few = F.broadcast(cut_lineage(picked[0].unionAll(picked[1])))
    return docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            counts[toxic].update(features(text))
    names = [*dict.fromkeys([*counts[0], *counts[1]])]
    numbers = [pa.array([counts[v][x] for x in names], pa.int64()) for v in (0, 1)]
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *numbers], names=["feature", "clean", "bad"])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_chain(x: np.ndarray, targets: dict[str, np.ndarray], fold: np.ndarray, shift: float = 0.0) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights of each link and the out-of-fold probabilities. Targets are 0, 1, or NaN where unknown.

    ``shift`` is added to intercepts: the log odds of the whole population less those of the sample.
    """
    links, before = {}, np.zeros((len(x), 0))
    for name, y in targets.items():
        known = ~np.isnan(y)
        inputs = np.hstack([x, before])
        out = np.zeros(len(x))
        for f in range(FOLDS):
            train = known & (fold != f)
            w = _fit(inputs[train], y[train])
            out[fold == f] = _sigmoid(inputs[fold == f] @ w[:-1] + w[-1] + shift)
        w = _fit(inputs[known], y[known])
        w[-1] += shift
        links[name], before = w, np.hstack([before, out[:, None]])
    return links, before


class Model:
    """Vocabulary and weights; small enough to travel with the task."""

    def __init__(self, vocabulary: list[str], links: dict[str, np.ndarray]):
        self.at = {f: i for i, f in enumerate(vocabulary)}
        self.links = links

    def rows(self, texts: pd.Series) -> np.ndarray:
        x = np.zeros((len(texts), len(self.at)), np.float32)
        whole = {f for f in self.at if not f.endswith("*")}
        stems = {n: {f[:n] for f in self.at if f.endswith("*") and len(f) == n + 1} for n in PREFIXES}
        for i, text in enumerate(texts):
            found = set(WORD.findall((text or "").lower()))
            for w in found & whole:
                x[i, self.at[w]] = 1
            for n, known in stems.items():
                if known:
                    for w in known.intersection([w[:n] for w in found]):
                        x[i, self.at[w + "*"]] = 1
        return x

    def probabilities(self, texts: pd.Series) -> pd.DataFrame:
        inputs, out = self.rows(texts), {}
        for name, w in self.links.items():
            out[name] = _sigmoid(inputs @ w[:-1] + w[-1])
            inputs = np.hstack([inputs, out[name][:, None]])
        return pd.DataFrame(out)


def _active(model: Model):
    """Places of the features of each text, and the categories whose words it has."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [set(WORD.findall((t or "").lower())) for t in batch.text]
            out = batch.drop(columns="text").assign(active=[np.flatnonzero(r).astype(np.int32) for r in model.rows(batch.text)])
            yield out.assign(**{c: [not f.isdisjoint(w) for f in found] for c, w in CATEGORY_WORDS.items()})

    return rows


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The chain fitted on the labelled documents; None if a class has no label."""
    sample = cut_lineage(labelled_sample(docs, labels))
    shares = {r.toxic: r["count"] for r in labels.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    share = lambda c: F.col(c) / float(sizes[int(c == "bad")])
    pooled = (F.col("bad") + F.col("clean")) / float(sum(sizes.values()))
    counts = sample.select("text", "toxic").mapInArrow(_feature_counts, "feature string, clean long, bad long")
    best = (
        counts.groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
        .where(F.col("clean") + F.col("bad") >= 3)
        .select("feature", (F.pow(share("bad") - share("clean"), 2) / (pooled * (1 - pooled) + 1e-3)).alias("chi"))
        .orderBy(F.desc("chi"), "feature")
        .limit(FEATURES)
        .collect()
    )
    vocabulary = [r.feature for r in best]
    folds = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int")
    narrow = sample.select("doc_id", "toxic", folds.alias("fold"), "text").mapInPandas(_active(Model(vocabulary, {})), ACTIVE)
    rows = narrow.toPandas().sort_values("doc_id", ignore_index=True)  # at most SAMPLE_ROWS rows of FEATURES numbers
    toxic = rows.toxic.to_numpy(float)
    x = np.zeros((len(rows), len(vocabulary)))
    for i, active in enumerate(rows.active):
        x[i, active] = 1
    named = {c: rows[c].to_numpy(bool) for c in CATEGORY_WORDS}
    unnamed = (toxic == 1) & ~np.any(list(named.values()), axis=0)
    targets = {}
    for c, has in named.items():
        if (has & (toxic == 1)).sum() >= 2 * FOLDS:
            targets[c] = np.where(unnamed, np.nan, has & (toxic == 1))
    targets["toxic"] = toxic
    fold = rows.fold.to_numpy()
    shift = np.log(shares[1] / shares[0]) - np.log(sizes[1] / sizes[0])
    return Model(vocabulary, fit_chain(x, targets, fold, shift)[0])


def toxicity_scores(model: Model | None, text: Column) -> Column:
    """Struct of the probability of each category and ``is_toxic``."""
    if model is None:
        return F.struct(*[F.lit(None).cast("double").alias(c) for c in CATEGORIES], F.lit(False).alias("is_toxic"))
    kind = ", ".join(f"{c} double" for c in CATEGORIES) + ", is_toxic boolean"

    @F.pandas_udf(kind)
    def score(texts: pd.Series) -> pd.DataFrame:
        parts = [model.probabilities(texts.iloc[i : i + 500]) for i in range(0, max(len(texts), 1), 500)]
        out = pd.concat(parts, ignore_index=True).reindex(columns=list(CATEGORIES)).astype(float)
        return out.assign(is_toxic=out["toxic"] >= THRESHOLD)

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, insult, contempt, toxic_probability, toxic)`` for each row of ``docs``."""
    scored = docs.select("doc_id", toxicity_scores(train(docs, labels), F.col("text")).alias("s"))
    return scored.select("doc_id", "s.insult", "s.contempt", F.col("s.toxic").alias("toxic_probability"), F.col("s.is_toxic").alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the toxic ones."""
    score = toxicity_scores(train(docs, labels), F.col("text"))
    return docs.select(F.struct(*docs.columns).alias("row"), score.alias("s")).where("not s.is_toxic").select("row.*")
