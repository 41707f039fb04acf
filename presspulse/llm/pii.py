"""Personal data: fixed-format spans, and candidates selected by boosted trees.

Column expressions and ``pyspark.ml`` only; no Python runs on the executors.

Base spans (``email``, ``ip``, ``card``, ``phone``) are the leftmost non-overlapping matches of each kind
that pass its check. Three generators then propose further spans with high recall, overlapping the base
and each other: token-like strings with a digit (``secret``), groups of digits (``number``), anything
around an ``@`` (``address``). Gradient-boosted trees score them from their format and the characters
around them. The trees are trained here on weak labels: a candidate is personal if it is exactly a base
span or stands after a cue of its generator: a credential word (``token = ...``), a word for telephones or
accounts, a word for mail. The cue is no feature of the candidates it labels, so the trees have to find what
stands without one. The training documents are a bounded sample, the ``SAMPLE_DOCS`` first by a hash of their
id, but for three in ten. A threshold for each generator is calibrated on all other documents, on the
candidates that touch no base span: the lowest with a precision of at least ``PRECISION``, counted against
the weak labels. A generator without such a threshold selects nothing by score. Values of credentials are
selected whatever their score. The fitted trees become one Column expression, so scoring needs neither a
shuffle nor a join.

Positions are code points, ends exclusive. Patterns are possessive or anchored where this cannot change
their matches, so that long runs take linear time, and offsets are summed in blocks.

Defined results: a null text is empty and has no spans; rows are independent, so repeated rows and null
ids get their own results; without weak labels of both kinds there are no trees, and only values of
credentials are added; equal scores keep the leftmost,
then the longest.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presspulse.functions.text import bind
from presspulse.sources.storage import cut_lineage

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "number", "address")
LOCAL = "A-Za-z0-9._%+-"
#: A match may begin inside a run of its characters only where the match before it ended.
BASE_PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GENERATORS = {
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{16,}+",
    "number": r"(?<![A-Za-z0-9])[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}+",
    "address": r"(?<![^\s@<>\"])[^\s@<>\"]{1,64}+@[^\s@<>\"]{3,}+",
}
CREDENTIAL = r"(?i)(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_ -]?key|auth(?:orization)?|bearer)[\"']?\s{0,3}[=:]?\s{0,3}[\"']?$"
#: The same where the word is part of the match: ``password=...``.
CREDENTIAL_INSIDE = r"(?i)^(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|auth(?:orization)?|bearer)="
TELEPHONE = r"(?i)\b(?:tel(?:ephone)?|phone|call|(?:tele)?fax|mobile|cell)\W{0,4}$"
ACCOUNT = r"(?i)\b(?:card|account|iban|visa|ssn|passport|id|no|number)\W{0,4}$"
MAIL = r"(?i)\b(?:e-?mail|mailto|contact|write(?: to)?|reply(?: to)?|address|from:|to:|cc:)\W{0,4}$"
BEFORE = 28

SAMPLE_DOCS = 8000
TREES, DEPTH = 12, 3
PRECISION = 0.9
GRID = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
BLOCK = 512


def _running(lengths: Column, base: Column) -> Column:
    """Sums of all elements before each, plus ``base``."""
    start = F.struct(base.alias("at"), F.array().cast("array<bigint>").alias("out"))
    step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    return F.aggregate(lengths, start, step, lambda acc: acc["out"])


def _sums_before(lengths: Column) -> Column:
    """As ``_running``, in blocks: appending to one long array would take quadratic time."""
    total = lambda block: F.aggregate(block, F.lit(0).cast("bigint"), lambda s, x: s + x)
    cut = lambda xs: F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int")), lambda i: F.slice(xs, i * BLOCK + 1, F.lit(BLOCK)))
    return bind(cut(lengths), lambda blocks: F.flatten(F.zip_with(blocks, _running(F.transform(blocks, total), F.lit(0).cast("bigint")), _running)))


def located(text: Column, pattern: str) -> Column:
    """All matches as an array of ``(start, end, match)``."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")

    def place(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, F.lit(pattern), -1), F.lit(1), F.size(found)), lambda p: F.length(p).cast("bigint"))
        both = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), F.length(m).cast("bigint").alias("n"), m.alias("match")))

        def spans(parts: Column) -> Column:
            starts = _sums_before(F.transform(parts, lambda x: x["gap"] + x["n"]))
            return F.zip_with(
                parts,
                starts,
                lambda x, s: F.struct((s + x["gap"]).alias("start"), (s + x["gap"] + x["n"]).alias("end"), x["match"].alias("match")),
            )

        return bind(both, spans)

    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(place(found)))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            F.split(match, r"\."), lambda p: F.coalesce(F.right(p, F.lit(9)).try_cast("int"), F.lit(999)) <= 255
        )
    if kind == "card":
        return luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of ``(kind, start, end)``: by kind as listed, then by start."""

    def of_kind(kind: str) -> Column:
        held = F.filter(located(text, BASE_PATTERNS[kind]), lambda s: _holds(kind, s["match"]))
        return F.transform(held, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return F.concat(*map(of_kind, BASE_KINDS))


def _cue(kind: str, match: Column, before: Column) -> Column:
    """Whether the words at a candidate say that it is personal."""
    if kind == "secret":
        return before.rlike(CREDENTIAL) | match.rlike(CREDENTIAL_INSIDE)
    if kind == "number":
        return before.rlike(TELEPHONE) | before.rlike(ACCOUNT)
    return before.rlike(MAIL)


def _features(kind: str, match: Column, before: Column, after: Column) -> list[tuple[str, Column]]:
    """Format and surroundings, but for the cues by which candidates of ``kind`` are labelled."""
    none = F.lit(0)
    match = F.regexp_replace(match, CREDENTIAL_INSIDE, "") if kind == "secret" else match
    count = lambda keep: F.length(F.regexp_replace(match, f"[^{keep}]", ""))
    return [
        ("length", F.length(match)),
        ("digits", count("0-9")),
        ("lower", count("a-z")),
        ("upper", count("A-Z")),
        ("dots", count(".")),
        ("gaps", count(" ()-")),
        ("different", F.size(F.array_distinct(F.split(match, "")))),
        ("plus", match.startswith("+").cast("int")),
        ("at", match.contains("@").cast("int")),
        ("host", match.rlike(r"@[\p{L}\p{N}-]+\.[\p{L}\p{N}-]").cast("int")),
        ("hex", match.rlike("^[0-9a-fA-F]++$").cast("int")),
        ("secret", F.lit(int(kind == "secret"))),
        ("number", F.lit(int(kind == "number"))),
        ("credential", none if kind == "secret" else before.rlike(CREDENTIAL).cast("int")),
        ("telephone", none if kind == "number" else before.rlike(TELEPHONE).cast("int")),
        ("account", none if kind == "number" else before.rlike(ACCOUNT).cast("int")),
        ("set", before.rlike("[=:\"']\\s?$").cast("int")),
        ("joined_before", before.rlike(r"[\p{L}\p{N}]$").cast("int")),
        ("joined_after", after.rlike(r"^[\p{L}\p{N}]").cast("int")),
        ("quoted", after.rlike("^[\"']").cast("int")),
    ]



def candidates(text: Column) -> Column:
    """Array of ``(kind, start, end, cue, features)`` from all generators."""

    def of_kind(kind: str) -> Column:
        def describe(s: Column) -> Column:
            before = F.substring(text, F.greatest(s["start"] - BEFORE + 1, F.lit(1)).cast("int"), F.least(s["start"], F.lit(BEFORE)).cast("int"))
            after = F.substring(text, (s["end"] + 1).cast("int"), F.lit(1))
            feats = F.array(*[c.cast("double") for _, c in _features(kind, s["match"], before, after)])
            return F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), _cue(kind, s["match"], before).alias("cue"), feats.alias("features")
            )

        return F.transform(located(text, GENERATORS[kind]), describe)

    return F.concat(*map(of_kind, ADDED_KINDS))


class Selector:
    """Fitted trees and thresholds as plain values."""

    def __init__(self, trees: list[tuple[float, tuple]], thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, features: Column) -> Column:
        def walk(node: tuple) -> Column:
            if len(node) == 1:
                return F.lit(node[0])
            at, limit, low, high = node
            return F.when(F.get(features, F.lit(at)) <= limit, walk(low)).otherwise(walk(high))

        margin = reduce(lambda a, b: a + b, [walk(t) * w for w, t in self.trees])
        return 1 / (1 + F.exp(-2 * margin))

    def selects(self, kind: Column, cue: Column, features: Column) -> Column:
        credential = F.when(cue & (kind == "secret"), 1.0)
        if not self.trees:
            return credential
        limit = F.lit(2.0)  # above any score
        for k, t in self.thresholds.items():
            limit = F.when(kind == k, F.lit(t)).otherwise(limit)
        return credential.otherwise(bind(self.score(features), lambda s: F.when(s >= limit, s)))


def _parse(lines: list[str]) -> tuple:
    """A tree from its printed form: ``(prediction,)`` or ``(feature, threshold, low, high)``."""
    line = lines.pop(0).strip()
    if m := re.match(r"Predict: (\S+)", line):
        return (float(m[1]),)
    at, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _parse(lines)
    lines.pop(0)  # Else
    return (int(at), float(limit), low, _parse(lines))


def _labelled(docs: DataFrame) -> DataFrame:
    """``(doc_id, kind, features, covered, label)`` of the candidates of ``docs(doc_id, text)``."""
    text = F.col("text")
    found = docs.where("text is not null").select("doc_id", F.struct(base_spans(text).alias("base"), candidates(text).alias("found")).alias("s"))
    rows = found.select("doc_id", F.transform("s.base", lambda b: F.struct(b["start"], b["end"])).alias("base"), F.explode("s.found").alias("c"))
    return rows.select(
        "doc_id",
        "c.kind",
        "c.features",
        F.exists("base", lambda b: (b["start"] < F.col("c.end")) & (F.col("c.start") < b["end"])).alias("covered"),
        (F.col("c.cue") | F.array_contains("base", F.struct("c.start", "c.end"))).cast("int").alias("label"),
    )


def train(docs: DataFrame) -> Selector:
    """Trees from the sample of ``docs``, thresholds from all others; no trees if the sample has weak labels of one kind only."""
    ids = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(10)) < 3
    ids = cut_lineage(ids.withColumn("held", held))  # at most SAMPLE_DOCS ids
    sample = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id")), "doc_id")
    rows = cut_lineage(_labelled(sample).withColumn("held", held))
    if rows.where("not held").select("label").distinct().count() < 2:
        return Selector([], {})
    width = rows.select(F.size("features").alias("n")).first().n
    wide = rows.where("not held").select("label", *[F.get("features", F.lit(i)).alias(f"f{i}") for i in range(width)])
    wide = VectorAssembler(inputCols=[f"f{i}" for i in range(width)], outputCol="v").transform(wide)
    fitted = GBTClassifier(featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=1).fit(wide)
    trees = [(float(w), _parse(t.toDebugString.splitlines()[1:])) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True)]
    unseen = docs.select("doc_id", "text").join(F.broadcast(ids.where("not held").select("doc_id")), "doc_id", "left_anti")
    scored = _labelled(unseen).where("not covered").select("kind", "label", Selector(trees, {}).score(F.col("features")).alias("p"))
    sums = [F.sum(F.when(F.col("p") >= t, x)).alias(f"{n}{i}") for i, t in enumerate(GRID) for n, x in (("hit", F.col("label")), ("all", F.lit(1)))]
    thresholds = {}
    for row in scored.groupBy("kind").agg(*sums).collect():
        good = [t for i, t in enumerate(GRID) if row[f"all{i}"] and row[f"hit{i}"] / row[f"all{i}"] >= PRECISION]
        if good:
            thresholds[row.kind] = good[0]
    return Selector(trees, thresholds)


def _apart(spans: Column) -> Column:
    """Spans sorted by start that begin at or after the end of the one kept before."""
    kind = "struct<upto:bigint,out:array<struct<start:bigint,end:bigint,kind:string>>>"
    first = F.struct(F.lit(0).cast("bigint").alias("upto"), F.array().alias("out")).cast(kind)
    step = lambda acc, s: F.when(s["start"] < acc["upto"], acc).otherwise(
        F.struct(s["end"].alias("upto"), F.concat(acc["out"], F.array(F.struct(s["start"], s["end"], s["kind"]))).alias("out")).cast(kind)
    )
    return F.aggregate(spans, first, step, lambda acc: acc["out"])


def added_spans(text: Column, base: Column, selector: Selector | None) -> Column:
    """Selected candidates that touch no base span and not each other: by kind as listed, then start."""
    plain = "array<struct<kind:string,start:bigint,end:bigint>>"
    if selector is None:
        return F.array().cast(plain)
    scored = F.transform(candidates(text), lambda c: F.struct(c["start"], (-c["end"]).alias("back"), c["end"], c["kind"], selector.selects(c["kind"], c["cue"], c["features"]).alias("p")))
    free = F.filter(scored, lambda c: c["p"].isNotNull() & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    lone = bind(free, lambda f: F.filter(f, lambda c: ~F.exists(f, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"]) & (o["p"] > c["p"]))))
    apart = _apart(F.transform(F.array_sort(lone), lambda c: F.struct(c["start"], c["end"], c["kind"])))
    of_kind = lambda spans, kind: F.transform(F.filter(spans, lambda s: s["kind"] == kind), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return bind(apart, lambda spans: F.concat(*[of_kind(spans, k) for k in ADDED_KINDS])).cast(plain)


def found_spans(text: Column, selector: Selector | None) -> Column:
    """Struct of ``base`` and ``added`` spans, each an array of ``(kind, start, end)``."""
    return bind(
        F.coalesce(text, F.lit("")),
        lambda t: bind(base_spans(t), lambda base: F.struct(base.alias("base"), added_spans(t, base, selector).alias("added"))),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, added)`` for each row of ``docs``: arrays of ``(kind, start, end)``."""
    return docs.select("doc_id", found_spans(F.col("text"), train(docs)).alias("found")).select("doc_id", "found.base", "found.added")


def _unions(spans: Column) -> Column:
    """Unions of overlapping spans, sorted by start, under the kind of the first one."""
    array = "array<struct<start:bigint,end:bigint,kind:string>>"
    kind = f"struct<last:struct<start:bigint,end:bigint,kind:string>,out:{array}>"
    first = F.struct(F.lit(None).alias("last"), F.array().alias("out")).cast(kind)
    grown = lambda last, s: F.struct(last["start"], F.greatest(last["end"], s["end"]).alias("end"), last["kind"])
    done = lambda acc: F.when(acc["last"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["last"])))
    step = lambda acc, s: F.when(s["start"] < acc["last"]["end"], F.struct(grown(acc["last"], s).alias("last"), acc["out"].alias("out")).cast(kind)).otherwise(
        F.struct(s.alias("last"), done(acc).alias("out")).cast(kind)
    )
    return F.aggregate(spans, first, step, done)


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become their union under the kind of the first."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["end"], s["kind"])))

    def build(kept: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            last = F.coalesce(F.get(kept, i - 1)["end"], F.lit(0))
            return F.concat(F.substring(text, (last + 1).cast("int"), (s["start"] - last).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]"))

        rest = F.substring(text, (F.coalesce(F.get(kept, F.size(kept) - 1)["end"], F.lit(0)) + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(F.transform(kept, piece), ""), rest)

    return bind(_unions(F.transform(order, lambda s: F.struct(s["start"], s["end"], s["kind"]))), build)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``n_chars``, where it is, counts the new text."""
    found = found_spans(F.col("text"), train(docs))
    new = F.when(F.col("text").isNotNull(), bind(found, lambda s: bind(F.concat(s["base"], s["added"]), lambda all_: F.when(F.size(all_) == 0, F.col("text")).otherwise(redacted(F.col("text"), all_)))))
    out = docs.withColumn("text", new)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
