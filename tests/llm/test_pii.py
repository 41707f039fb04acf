from __future__ import annotations

import collections
import hashlib
import re

import pytest
from helpers import awkward, docs
from pyspark.sql import functions as F

from presspulse.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


TEXTS = [
    "a@b.c%x@d.e foo@bar a.b@c-d.e.f. 999.1.2.3.4 1.2.3.4.5.6.7.8 0001.02.3.255 4111 1111 1111 1111",
    "x4111-1111-1111-1111 4111  1111 11111111111111111111111111 4539 1488 0343 6467 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "😀 +1 (743) 555-3824 é +49 30 1234567.8 +1 +2)) 3 ++123456789 call +123456789",
    "1 2.2.2.2 " * 700 + "x@y.zz " * 700,
    "٣٣.1.1.1 1.1.1.٣ 00000000000000255.1.1.1 99999999999999999999.1.1.1 a@b@c.d.e x@a..b y@-.- z@a.b.",
    "1" * 20_000 + "." + "a" * 20_000 + "@b.c",
]


def sample(n=400):
    """Documents with credentials, telephone numbers, cards and ordinary numbers."""
    out = []
    for i in range(n):
        key = hashlib.sha1(str(i).encode()).hexdigest()
        kinds = (f'token = "{key}" ', f"+1 (212) 555-{i:04d} ", f"mail{i}@host.example.org ", f"order 55{i:05d}1 ", f"see item-{i}-of-the-long-list-0001 ")
        out.append((i, f"word number {i} and " + kinds[i % 5] + " then the rest"))
    return out


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pii"))
    rows = sample() + [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(2000 + (i or 0), t) for i, t in awkward("7 " * 30_000)]
    docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return rows, queries.op5_pii(spark, folder).collect()


def test_base_spans_equal_plain_matching(result):
    rows, got = result
    count = collections.Counter()
    for i, t in rows:
        spans = brute(t)
        n = collections.Counter(k for k, _, _ in spans)
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        count[(i, n["email"], n["ip"], n["card"], n["phone"], digest)] += 1
    assert collections.Counter(tuple(r)[:6] for r in got) == count


def test_base_spans_stay_and_credentials_are_added(result):
    rows, got = result
    text = dict(rows)
    added = {r.doc_id: [s for s in r.spans.split(",") if s.split(":")[0] in pii.ADDED_KINDS] for r in got}
    for r in got:
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(text[r.doc_id]))
        assert r.spans.startswith(base)
    tokens = [i for i in range(400) if i % 5 == 0]
    hits = [i for i in tokens for s in added[i] if text[i][int(s.split(":")[1]) : int(s.split(":")[2])] == hashlib.sha1(str(i).encode()).hexdigest()]
    assert len(hits) > 0.9 * len(tokens)
    assert sum(bool(added[i]) for i in range(400) if i % 5 >= 3) < 16


def test_redaction(spark):
    text = "a x@y.zz b +1 (743) 555-3824, é 1.2.3.4"
    row = spark.createDataFrame([(text,), ("none",)], "text string")
    out = row.select(pii.redacted(F.col("text"), pii.base_spans(F.col("text"))).alias("t")).collect()
    assert [r.t for r in out] == ["a [EMAIL] b [PHONE], é [IP]", "none"]
    rows = docs(spark, [(1, text), (2, None), (2, None)])
    got = pii.redact(rows)
    assert got.columns == rows.columns
    assert [(r.doc_id, r.text, r.n_chars) for r in got.orderBy("doc_id").collect()] == [(1, out[0].t, len(out[0].t)), (2, None, None), (2, None, None)]


def test_empty_table(spark):
    assert pii.personal_data(docs(spark, [])).count() == 0


def test_trees_as_columns_equal_the_fitted_model(spark):
    tree = (1, 0.5, (0.25,), (0, 2.0, (-1.0,), (1.0,)))
    chosen = pii.Selector([(1.0, tree), (0.1, tree)], {"secret": 0.5})
    row = spark.createDataFrame([([3.0, 1.0],), ([1.0, 1.0],), ([9.0, 0.0],)], "f array<double>")
    p = [r.p for r in row.select(chosen.score(F.col("f")).alias("p")).collect()]
    expect = lambda v: 1 / (1 + 2.718281828459045 ** (-2.2 * v))
    assert p == pytest.approx([expect(1.0), expect(-1.0), expect(0.25)])


def test_each_generator_is_selected(spark):
    """Telephone numbers without +, addresses with other letters and secrets, after a word that says so or not."""
    rows = []
    for i in range(600):
        said = i % 180 < 174
        kinds = (
            ("secret", "password=" if said else "seen ", hashlib.sha1(str(i).encode()).hexdigest()),
            ("number", "call " if said else "ring ", f"(0171) 555-{i:04d}"),
            ("address", "contact " if said else "ask ", f"jör{i}é@hóst{i}.example"),
            (None, "order ", f"55{i:05d}1"),
            (None, "see ", f"item-{i}-of-the-long-list-0001"),
            (None, "at ", f"@home@{i}"),
        )
        kind, words, value = kinds[i % 6]
        rows.append((i, f"some {words}{value} then", kind, value))
    frame = docs(spark, [r[:2] for r in rows])
    added = {r.doc_id: [(s.kind, rows[r.doc_id][1][s.start : s.end]) for s in r.added] for r in pii.personal_data(frame).collect()}
    for kind in pii.ADDED_KINDS:
        own = [r for r in rows if r[2] == kind]
        assert sum(any(k == kind and v.endswith(r[3]) for k, v in added[r[0]]) for r in own) > 0.9 * len(own), kind
        assert any(added[r[0]] for r in own if r[0] % 180 >= 174), kind
    assert not any(added[r[0]] for r in rows if r[2] is None)


def test_partly_overlapping_spans_are_redacted_whole(spark):
    texts = ["10.0.0.0 4111111111111111", "a 10.0.0.0 4111111111111111 b x@y.zz"]
    row = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.t for r in row.select(pii.redacted(F.col("text"), pii.base_spans(F.col("text"))).alias("t")).collect()] == ["[IP]", "a [IP] b [EMAIL]"]
    spans = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(s).cast("bigint").alias("start"), F.lit(e).cast("bigint").alias("end")) for k, s, e in (("card", 2, 9), ("ip", 1, 4), ("phone", 3, 5), ("email", 9, 10))])
    assert spark.range(1).select(pii.redacted(F.lit("abcdefghijkl"), spans)).first()[0] == "a[IP][EMAIL]kl"
