"""URL filters: explicit rules, and association rules mined from labels. DataFrame operations only.

An explicit rule fits a host and its subdomains where the path starts with the rule's; the longest wins.
For other urls, FP-growth mines combinations of url tokens that go with a block label. Rules below the
least support or confidence are left out, and so are rules that a shorter one with at least the same
confidence implies. Each rule is filed under its rarest token; a url looks up its tokens there, so it is
compared only with rules it shares that token with. A url is blocked if a rule's tokens are all its own.

Itemsets could outnumber the urls many times: 20 tokens that a url template always has make a million. Three steps
before mining prevent that and lose no verdict. Tokens in the same labelled urls are one, their class, and a rule
needs any token of a class. Tokens in too few blocked urls can be in no rule. A token that is a rule by itself
decides alone, so longer rules with it are not mined.

Labels are those of the documents with the pages' ids; low quality or toxic means block. Explicit rules
are no labels: they hold for their own hosts and would teach little else.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and the verdict
allow; repeated rows and null ids get their own results; a page with several labels is blocked if one
says so; without block labels nothing is mined.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presspulse.functions.text import bind
from presspulse.sources.storage import broadcast_if_small, cut_lineage

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
SUPPORT, CONFIDENCE = 0.002, 0.8
LEAST_ROWS = 5  # urls that a combination must have, however few there are
BLOCK = "label=block"


def host_and_path(url: Column) -> Column:
    """Struct of ``host`` and ``path``; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return bind(
        F.coalesce(rest, F.lit("")),
        lambda r: F.struct(
            F.translate(F.regexp_extract(r, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase).alias("host"),
            F.regexp_extract(r, "^[^/?#]*([^?#]*)", 1).alias("path"),
        ),
    )


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """Struct of the longest fitting ``rule`` and its ``verdict``, or null: looks up the host's suffixes."""
    filed: dict[str, list[Column]] = {}
    for name, prefix, verdict in rules:
        filed.setdefault(name, []).append(F.struct(F.lit(len(name + prefix)).alias("n"), F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(prefix).alias("prefix")))
    index = F.create_map(*[x for name, held in filed.items() for x in (F.lit(name), F.array(*held))])
    parts = F.split(host, r"\.")
    suffixes = bind(parts, lambda p: F.transform(p, lambda _, i: F.array_join(F.slice(p, i + 1, F.size(p)), ".")))
    held = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(index, s)), lambda x: x.isNotNull()))
    return F.array_max(F.filter(held, lambda r: path.startswith(r["prefix"])))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Host labels, words of the path with numbers as one, names of query parameters, and the scheme."""
    labelled = lambda kind, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    plain = F.regexp_replace(F.lower(path), r"[0-9]+", "#")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return F.array_distinct(
        F.concat(
            labelled("host=", F.split(host, r"\.")),
            labelled("path=", F.split(plain, r"[/._~-]+")),
            labelled("query=", F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^[^=]*", 0))),
            F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, "^(.*?)://", 1)))),
        )
    )


def implied_by(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows(key, tokens)`` joined with ``rules(token, needs, ...)``, filed by ``token``, whose ``needs`` they hold."""
    looked_up = rows.select("*", F.explode("tokens").alias("token")).join(rules, "token")
    return looked_up.where(F.size(F.array_except("needs", "tokens")) == 0)


def token_classes(labelled: DataFrame) -> DataFrame:
    """``(token, class, n, n_bad)`` of ``labelled(tokens, bad)``: tokens of the same rows share a class, which the
    smallest of them names. Rows are told apart by their tokens, and sets of rows by two 64-bit hashes."""
    kinds = labelled.select(F.array_sort(F.array_distinct("tokens")).alias("tokens"), F.col("bad").cast("long").alias("bad"))
    kinds = kinds.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("n_bad"))
    rows = kinds.select("n", "n_bad", F.xxhash64("tokens").alias("h1"), F.xxhash64(F.lit(1), "tokens").alias("h2"), F.explode("tokens").alias("token"))
    held = rows.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    alike = ["n", "n_bad", "h1", "h2"]
    return cut_lineage(held).transform(lambda t: t.join(t.groupBy(*alike).agg(F.min("token").alias("class")), alike)).select("token", "class", "n", "n_bad")


def in_classes(rows: DataFrame, key: str, classes: DataFrame) -> DataFrame:
    """``(key, tokens)``: the classes that the tokens of ``rows(key, tokens)`` are in; rows without any are left out."""
    named = rows.select(key, F.explode("tokens").alias("token")).join(classes.select("token", "class"), "token")
    return named.groupBy(key).agg(F.collect_set("class").alias("tokens"))


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """``(token, needs, confidence, support)`` from ``labelled(tokens, bad)``, whose tokens are classes, and the
    ``(token, class)`` of the classes in these rules."""
    total = labelled.count()
    least = min(1.0, max(support, LEAST_ROWS / max(1, total)))
    classes = token_classes(labelled)
    useful = cut_lineage(classes.where(F.col("n_bad") >= math.ceil(least * total)))
    share = F.col("n_bad") / F.col("n")
    alone = useful.where((F.col("token") == F.col("class")) & (share >= confidence))
    alone = alone.select("token", F.array("token").alias("needs"), share.alias("confidence"), (F.col("n_bad") / total).alias("support"))
    left = useful.where(share < confidence)
    keyed = cut_lineage(labelled.withColumn("row", F.monotonically_increasing_id()))
    items = keyed.select("row", "bad").join(in_classes(keyed, "row", left), "row", "left")
    items = items.select(F.concat(F.coalesce("tokens", F.array().cast("array<string>")), F.when(F.col("bad"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items"))
    fitted = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(cut_lineage(items))
    found = fitted.associationRules.where(F.array_contains("consequent", BLOCK) & (F.size("antecedent") > 0))
    found = found.select(F.array_sort("antecedent").alias("needs"), "confidence", "support")
    rarest = (
        found.select("needs", F.explode("needs").alias("token"))
        .join(left.where("token = class").select("token", "n"), "token")
        .groupBy("needs")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    )
    filed = cut_lineage(found.join(rarest, "needs").select("token", "needs", "confidence", "support"))
    longer = filed.select(F.col("needs").alias("tokens"), F.col("confidence").alias("own"))
    spare = implied_by(longer, filed).where((F.size("needs") < F.size("tokens")) & (F.col("confidence") >= F.col("own")))
    short = filed.join(spare.select(F.col("tokens").alias("needs")).distinct(), "needs", "left_anti").select("token", "needs", "confidence", "support")
    rules = cut_lineage(alone.unionByName(short))
    needed = rules.select(F.explode("needs").alias("class")).distinct()
    return rules, useful.select("token", "class").join(needed, "class", "left_semi").select("token", "class")


def judged_urls(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, confidence)`` for each row of ``pages(page_id, url)``."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    parts = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", parts.alias("u")).select("page_id", "url", "u.host", "u.path")
    urls = urls.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    tokens = url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")
    labelled = cut_lineage(urls.where("host <> ''").join(known.where("bad is not null"), "page_id").select(tokens, "bad"))
    mined, classes = mined_rules(labelled)
    free = urls.where("fit is null and host <> ''").select("url", tokens).distinct()
    held = in_classes(free, "url", broadcast_if_small(cut_lineage(classes)))
    hits = implied_by(held, broadcast_if_small(mined)).groupBy("url").agg(F.max("confidence").alias("confidence"))
    blocked = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return urls.join(hits, "url", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", blocked).alias("verdict"), F.when(F.col("fit").isNull(), F.col("confidence")).alias("confidence")
    )
