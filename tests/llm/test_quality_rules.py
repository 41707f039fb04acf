from __future__ import annotations

import collections
import re

import pyarrow as pa
from helpers import awkward, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from presspulse.llm.quality_rules import BOILERPLATE, SENTENCE_ENDS, SEPARATORS, SYMBOLS, judge, line_quality

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    ws = re.findall(WORD, text)
    seen, dup, lines = set(), 0, []
    for line in text.split("\n"):
        own = re.findall(WORD, line)
        if not own:
            continue
        again = line in seen
        seen.add(line)
        dup += again
        n = len(own)
        symbols = sum(c in SYMBOLS for c in line)
        separators = sum(w in SEPARATORS for w in own)
        open_end = n >= 12 and line.rstrip(" \t\n\v\f\r")[-1] not in SENTENCE_ENDS and not any(c in ".!?:;" for c in line)
        furniture = n <= 30 and any(p in line.lower() for p in BOILERPLATE)
        failed = again or 2 * symbols > n or 2 * line.count("!") > n or open_end or (separators >= 3 and 4 * separators >= n) or furniture
        lines.append((failed, sum(map(len, own))))
    triples = collections.Counter(zip(ws, ws[1:], ws[2:]))
    covered = {i + j for i in range(len(ws) - 2) if triples[tuple(ws[i : i + 3])] > 1 for j in range(3)}
    chars = sum(map(len, ws))
    left = sum(c for f, c in lines if not f)
    base = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    symbols = sum(c in SYMBOLS for c in text)
    return (len(ws), chars, symbols, dup, len(covered), base, not base and left >= 0.5 * chars, len(lines), sum(f for f, _ in lines), left)


LINE = st.lists(st.sampled_from(["a", "b", "the", "|", "·", "x!", "y.", "é😀", "#$", "All", "rights", "reserved", "\t", "\r"]), max_size=20).map(" ".join)


@given(st.lists(st.one_of(st.none(), st.lists(LINE, max_size=8).map("\n".join)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_equals_the_plain_rules(texts):
    got = judge(pa.array(texts, pa.string()))
    assert [tuple(v[i].item() for v in got.values()) for i in range(len(texts))] == [brute(t) for t in texts]


def test_rules_remove_lines_first(spark):
    good = "\n".join(f"The w{i}a w{i}b w{i}c and w{i}d then w{i}e ended here{i}." for i in range(8))
    menu = "\n".join(f"Home{i} | About{i} | Contact{i} | More{i}" for i in range(40))
    rows = [(1, good), (2, good + "\nAll rights reserved."), (3, good + "\n" + menu), (4, None)]
    got = {r.doc_id: r for r in line_quality(docs(spark, rows)).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert got[2].n_removed_lines == 1 and not got[3].base_failed and got[4].base_failed


def test_awkward_rows(spark):
    rows = awkward()
    got = line_quality(docs(spark, rows)).collect()
    assert collections.Counter((r.doc_id, *r[1:]) for r in got) == collections.Counter((i, *brute(t)) for i, t in rows)
    assert line_quality(docs(spark, [])).count() == 0
