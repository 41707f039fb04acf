"""Numeric scoring expressions: weights, thresholds, labels, vectors."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions.text import SPACE, bind, token_set
from presspulse.schemas import finite


def clamp(x: Column, lo: Column | float, hi: Column | float) -> Column:
    lo, hi = (v if isinstance(v, Column) else F.lit(float(v)) for v in (lo, hi))
    return F.greatest(lo, F.least(hi, x))


def safe_float(c: Column, default: float = 0.0) -> Column:
    """Number or default: NULL, NaN, infinities and unparsable strings give the default."""
    return F.coalesce(finite(c.try_cast("double")), F.lit(default))


# --- headline ---------------------------------------------------------------------


def headline_strength(c: Column) -> Column:
    """Highest anchor score that matches. Anchors are tried from the top score down, so the
    first hit is the maximum and the rest need not run."""
    ranked = sorted(C.HEADLINE_ANCHORS, key=lambda a: -a[1])
    score = F
    for pattern, value in ranked:
        score = score.when(c.rlike("(?iU)" + pattern), F.lit(value))
    return score.otherwise(F.lit(C.HEADLINE_FLOOR))


def blended_strength(anchor: Column, model: Column, blend: float = 0.3) -> Column:
    mixed = clamp(F.lit(1 - blend) * anchor + F.lit(blend) * model, C.HEADLINE_FLOOR, 1.0)
    return F.coalesce(F.when(model.isNotNull(), mixed), anchor)


# --- weights ----------------------------------------------------------------------


def source_reliability(
    c: Column,
    table: Sequence[tuple[str, float]] = tuple(C.SOURCE_RELIABILITY),
    named: float = C.SOURCE_DEFAULT_NAMED,
    blank: float = C.SOURCE_DEFAULT_BLANK,
) -> Column:
    """Weight of the longest key contained in the source name; earlier keys win ties."""
    by_length = sorted(table, key=lambda kv: -len(kv[0]))  # stable: listing order within a length

    def longest(name: Column) -> Column:
        hits = [F.when(F.contains(name, F.lit(k.lower())), F.lit(float(w))) for k, w in by_length]
        return F.coalesce(*hits, F.lit(named))

    empty = c.isNull() | ~c.rlike(f"[^{SPACE}]")
    return F.when(empty, F.lit(blank)).otherwise(bind(F.lower(c), longest))


def recency_weight(hours: Column) -> Column:
    return F.exp(-F.greatest(F.lit(0.0), hours) / F.lit(24.0))


def raw_impact(*factors: Column) -> Column:
    out = factors[0]
    for f in factors[1:]:
        out = out * f
    return out


def topic_importance(probs: Sequence[Column], multipliers: Sequence[float], enabled: bool = True) -> Column:
    if not enabled:
        return F.lit(1.0)
    total = F.lit(0.0)
    for p, m in zip(probs, multipliers):
        total = total + F.coalesce(p, F.lit(0.0)) * F.lit(float(m))
    return total


# --- threshold and labels -----------------------------------------------------------


def adaptive_threshold(vol: Column, v_ref: Column | None = None, p: C.ThresholdParams = C.ThresholdParams()) -> Column:
    """Label threshold scaled by volatility relative to the universe; missing volatility counts as average."""
    ref = F.lit(p.v_ref if p.v_ref > 0 else C.DEFAULT_V_REF) if v_ref is None else v_ref
    ref = F.coalesce(F.when(finite(ref) > 0, ref), F.lit(C.DEFAULT_V_REF))
    v = finite(vol)
    ratio = F.coalesce(F.when(v > 0, v / ref), F.lit(1.0))
    return clamp(F.lit(p.base) * (1 + F.lit(p.k) * (ratio - 1)), p.min_threshold, p.max_threshold)


def sentiment_label(score: Column, threshold: Column) -> Column:
    return F.when(score > threshold, "Positive").when(score < -threshold, "Negative").otherwise("Neutral")


def sanitize_price(raw: Column, last_close: Column, pct: float = C.CLAMP_PCT) -> Column:
    """Clamp to the band around the last close; without a usable close the value passes through."""
    known = finite(last_close) > 0
    return F.when(known, clamp(raw, last_close * F.lit(1 - pct), last_close * F.lit(1 + pct))).otherwise(raw)


# --- distributions and vectors -------------------------------------------------------


def arg_max_name(names: Sequence[str], values: Sequence[Column]) -> Column:
    """Name of the largest value, the first one on ties."""
    arr = F.array(*values)
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(arr, F.array_max(arr)).cast("int"))


def uniform_topics() -> list[Column]:
    return [F.lit(1.0 / len(C.TOPIC_COLUMNS)) for _ in C.TOPIC_COLUMNS]


def softmax(values: Column) -> Column:
    """Stable softmax of an array column; a zero total gives the uniform distribution."""

    def spread(s: Column) -> Column:
        return F.transform(
            s["e"], lambda v: F.when(s["t"] == 0, F.try_divide(F.lit(1.0), F.size(s["e"]))).otherwise(
                F.try_divide(v, s["t"])
            )
        )

    def with_total(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
        return bind(F.struct(e.alias("e"), total.alias("t")), spread)

    def scaled(s: Column) -> Column:
        return bind(F.transform(s["v"], lambda v: F.exp(v - s["top"])), with_total)

    return bind(F.struct(values.alias("v"), F.array_max(values).alias("top")), scaled)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL, empty, unequal lengths or zero norms give 0."""
    usable = (F.size(a) > 0) & (F.size(a) == F.size(b))
    value = F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    return F.coalesce(F.when(usable, value), F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token sets; an empty side gives 0."""

    def ratio(s: Column) -> Column:
        union = F.size(s["a"]) + F.size(s["b"]) - s["n"]
        both = (F.size(s["a"]) > 0) & (F.size(s["b"]) > 0)
        return F.coalesce(F.when(both, F.try_divide(s["n"].cast("double"), union.cast("double"))), F.lit(0.0))

    def counted(s: Column) -> Column:
        shared = F.size(F.array_intersect(s["a"], s["b"]))
        return bind(F.struct(s["a"].alias("a"), s["b"].alias("b"), shared.alias("n")), ratio)

    return bind(F.struct(a.alias("a"), b.alias("b")), counted)


def text_jaccard(a: Column, b: Column) -> Column:
    return jaccard(token_set(a), token_set(b))


def scores_to_columns(scores: Column, labels: Sequence[str], lower: bool = False) -> list[Column]:
    """Spread ``array<struct<label,score>>`` over fixed columns; labels that are missing score 0.

    Of a repeated label the last score holds; entries without a label are ignored.
    """
    name = (lambda s: F.lower(s["label"])) if lower else (lambda s: s["label"])

    def of(label: str) -> Column:
        held = F.filter(scores, lambda s: F.coalesce(name(s) == label, F.lit(False)))
        return F.coalesce(F.get(F.transform(F.reverse(held), lambda s: s["score"]), F.lit(0)), F.lit(0.0)).alias(label)

    return [of(label) for label in labels]


def topic_overlap_scores(text: Column, sharpness: float = 10.0) -> Column:
    """Built-in topic scorer: softmax of the cosine between the token sets of the text and of each
    topic description. Stands where a trained classifier can be plugged in."""

    def score(tokens: Column) -> Column:
        sims = []
        for topic in C.TOPIC_COLUMNS:
            words = sorted(set(re.findall(r"\w+", C.TOPIC_DESCRIPTIONS[topic].lower())))
            shared = F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]))).cast("double")
            norm = F.sqrt(F.size(tokens).cast("double")) * F.lit(len(words) ** 0.5)
            sims.append(F.coalesce(F.try_divide(shared, norm), F.lit(0.0)) * F.lit(sharpness))
        return softmax(F.array(*sims))

    return bind(token_set(text), score)


def company_profile(name: Column, aliases: Column, keywords: Column, sector: Column) -> Column:
    parts = F.concat(
        F.array(name),
        F.coalesce(aliases, F.array().cast("array<string>")),
        F.coalesce(keywords, F.array().cast("array<string>")),
        F.array(sector),
    )
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), ". ")


def search_phrase(name: Column, aliases: Column) -> Column:
    names = F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>")))
    quoted = F.transform(
        F.filter(names, lambda n: n.isNotNull() & (n != "")), lambda n: F.concat(F.lit('"'), n, F.lit('"'))
    )
    return F.array_join(quoted, " OR ")


