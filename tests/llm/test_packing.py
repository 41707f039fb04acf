from __future__ import annotations

import collections
import zlib

import numpy as np
import public_tokenizers
from helpers import awkward, docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from presspulse.llm.packing import END, VOCABULARY, Packer, encoding, packed_pieces

REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*REFERENCE.encode(text or "", add_special_tokens=False).ids, END]


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_json_vocabulary(text):
    got = encoding(public_tokenizers.path(VOCABULARY)).encode_to_numpy(text, allowed_special="all")
    assert [*got.tolist(), END] == ids_of(text)


def test_special_token_in_a_text():
    text = "a <|endoftext|> b<|endoftext|>"
    assert encoding(public_tokenizers.path(VOCABULARY)).encode_to_numpy(text, allowed_special="all").tolist() == ids_of(text)[:-1]


def check(pieces, lengths, size):
    """Every id once, no gaps in sequences, full sequences or powers of two."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, length, _, tokens, sequence, offset in pieces:
        assert length > 0 and tokens == lengths[doc]
        by_doc[doc].append((start, length))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(lengths)
    for held, total in [(v, lengths[d]) for d, v in by_doc.items()] + [(v, None) for v in by_sequence.values()]:
        at = 0
        for start, length in sorted(held):
            assert start == at
            at += length
        if total is None:
            assert at == size or at & (at - 1) == 0 and at < size
        else:
            assert at == total


@given(st.lists(st.integers(1, 150), max_size=120), st.sampled_from([0, 65_400, 70_000]))
@settings(max_examples=150, deadline=None)
def test_packer_keeps_every_id(lengths, lowest):
    packer = Packer(0, 64)
    for i, n in enumerate(lengths):
        packer.add(i, np.arange(lowest, lowest + n, dtype=np.uint32))
    packer.empty()
    check(packer.done, dict(enumerate(lengths)), 64)
    for doc, start, length, crc, *_ in packer.done:
        assert crc == zlib.crc32(np.arange(lowest + start, lowest + start + length, dtype="<u4").tobytes())


def test_pieces_that_fit_nowhere_stay_apart_until_the_end():
    packer = Packer(0, 64)
    for i in range(6000):
        packer.add(i, np.zeros(40, np.uint32))
    assert not packer.done and packer.count[40] == 6000
    packer.empty()
    check(packer.done, dict.fromkeys(range(6000), 40), 64)


def test_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(5)
    packer = Packer(0, 32)
    for i in range(400):
        n = int(rng.integers(1, 31))
        before = packer.count.copy()

        def cost(level):
            after = before.copy()
            if level:
                after[level] -= 1
            if level + n < 32:
                after[level + n] += 1
            return int((after[1:32] ** 2).sum())

        best = min(cost(level) for level in range(0, 33 - n) if level == 0 or before[level])
        packer.add(i, np.zeros(n, np.uint32))
        assert int((packer.count[1:32] ** 2).sum()) == best


def test_pieces_of_a_table(spark):
    rows = [*awkward("long text " * 9000), *((i, f"document {i} " * (i % 90)) for i in range(10, 120))]
    rows = list({i: t for i, t in rows if i is not None}.items())
    got = packed_pieces(docs(spark, rows)).collect()
    check([tuple(r) for r in got], {i: len(ids_of(t)) for i, t in rows}, 2048)
    text = dict(rows)
    for r in got:
        part = np.array(ids_of(text[r.doc_id])[r.start : r.start + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32


def test_awkward_rows(spark):
    got = packed_pieces(docs(spark, awkward("q " * 3000))).collect()
    assert sum(r.length for r in got) == sum(len(ids_of(t)) for _, t in awkward("q " * 3000))
    assert packed_pieces(docs(spark, [])).count() == 0
