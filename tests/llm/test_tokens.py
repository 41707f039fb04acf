from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from presspulse.llm.tokens import shingles, slices, weighted_jaccard, words

TEXT = st.text(alphabet="abAB1é .,\n😀", max_size=60)


def plain(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_and_shingles_equal_when_the_words_do(texts):
    found = words(pa.array(texts, pa.string()))
    want = [plain(t) for t in texts]
    assert found.count.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    names = {}
    for h, w in zip(found.hash.tolist(), flat, strict=True):
        assert names.setdefault(h, w) == w
    assert len(names) == len(set(flat))
    bag = shingles(found)
    expected = [[tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w) for w in want]
    assert bag.count.tolist() == [len(e) for e in expected]
    seen = {}
    for h, s in zip(bag.hash.tolist(), [s for e in expected for s in e], strict=True):
        assert seen.setdefault(h, s) == s
    assert len(seen) == len({s for e in expected for s in e})


def test_a_slice_does_not_change_words():
    texts = pa.array(["a b", None, "c d e", "", "f"])
    assert words(texts.slice(2, 2)).hash.tolist() == words(pa.array(["c d e", ""])).hash.tolist()


def test_slices_cover_everything_in_order():
    sizes = np.array([5, 0, 100, 3, 3, 0])
    got = list(slices(sizes, 10))
    assert [i for b, e in got for i in range(b, e)] == list(range(6))
    assert (2, 3) in got or any(b <= 2 < e for b, e in got)


def test_weighted_jaccard():
    bag = lambda *x: np.array(x, np.uint64)
    assert weighted_jaccard(bag(1, 1, 2), bag(1, 2, 2)) == 0.5
    assert weighted_jaccard(bag(), bag()) == 0.0
    assert weighted_jaccard(bag(1, 1), bag(1, 1)) == 1.0
