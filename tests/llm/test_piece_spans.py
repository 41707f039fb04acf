from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from presspulse.llm.piece_spans import MODEL, NORMALIZER, PieceEncoder, digests, encoded, message

from helpers import HAS_TABLES, awkward, docs, table

PATH = public_tokenizers.path(MODEL)
with open(PATH, "rb") as f:
    PLAIN = f.read()


def with_rules(name, **settings_of):
    """The vocabulary with a normaliser that has a compiled character map."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name=name, **settings_of).serialized_normalizer_spec()
    size, prefix = len(spec), bytearray([NORMALIZER << 3 | 2])
    while True:
        prefix.append(size & 127 | (128 if size > 127 else 0))
        size >>= 7
        if not size:
            return PLAIN + bytes(prefix) + spec


MODELS = {
    "plain": PLAIN,
    "nmt_nfkc": with_rules("nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True),
    "nfkc_cf": with_rules("nfkc_cf", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=False),
    "nmt_nfkc_cf": with_rules("nmt_nfkc_cf", add_dummy_prefix=False, escape_whitespaces=True, remove_extra_whitespaces=True),
    "unescaped": with_rules("nfkc", add_dummy_prefix=True, escape_whitespaces=False, remove_extra_whitespaces=True),
}
ENCODERS = {k: (PieceEncoder(m), sentencepiece.SentencePieceProcessor(model_proto=m)) for k, m in MODELS.items()}
TEXT = st.text(alphabet="ab AB  .é́　 ﾊﾟＡﬁ①▁\n\t​ß가㌀\x00\x01𝔘日¨<s>", max_size=40)
SPECIAL = ["", " ", "   ", "　 　", "  a  b  ", "▁ ▁", "a▁", "éé", "ﷺ ㌀ ﬁ", "<0x0A> <s> </s>\n", "¨ ¨", "​", "​ a", " ​ a ", "\U0010ffff�"]


def same(name, text):
    own, library = ENCODERS[name]
    ids, starts, ends = next(own.encode([text.encode()]))
    want = library.encode(text, return_type="proto")
    assert ids.tolist() == [p.id for p in want.pieces]
    assert starts.tolist() == [p.begin for p in want.pieces]
    assert ends.tolist() == [p.end for p in want.pieces]


@pytest.mark.parametrize("name", MODELS)
@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_ids_and_spans_are_those_of_the_library(name, text):
    same(name, text)


@pytest.mark.parametrize("name", MODELS)
@pytest.mark.parametrize("text", SPECIAL)
def test_special_texts(name, text):
    same(name, text)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_under_a_compiled_map(text):
    same("nmt_nfkc", text)


def test_spans_tile_the_source_where_nothing_is_dropped():
    own, _ = ENCODERS["plain"]
    text = "Über 日本  𝔘\n end ".encode()
    _, starts, ends = next(own.encode([text]))
    assert b"".join(text[b:e] for b, e in zip(starts, ends, strict=True)) == text


def test_message_fields():
    assert {k for k, _ in message(PLAIN)} >= {1, 2, 3}


def test_awkward_rows(spark):
    rows = awkward()
    got = {}
    for r in encoded(docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for i in {i for i, _ in rows}:
        want = sorted((library.encode(t or "") for k, t in rows if k == i), key=len)
        assert [r["ids"] for r in sorted(got[i], key=lambda r: len(r["ids"]))] == want
    assert got[1][0]["decoded"] == "" and got[1][0]["ids"] == []
    assert encoded(docs(spark, [])).count() == 0


def test_bytes_that_are_no_utf8(spark):
    broken = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert encoded(broken).first()["decoded"] == "a�b"


@pytest.mark.skipif(not HAS_TABLES, reason="needs the test tables")
def test_digests_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in table(spark, "documents").collect():
        ids = library.encode(r["text"] or "")
        want[r["doc_id"]] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), len((r["text"] or "").encode()))
    assert {r[0]: tuple(r[1:]) for r in digests(table(spark, "documents")).collect()} == want


def test_a_map_without_entries_leaves_all():
    own, _ = ENCODERS["plain"]
    normal, align = own.normalize(b"a b")
    assert normal.decode() == "▁a▁b"
    assert np.array_equal(align, [0, 0, 0, 0, 1, 1, 1, 2, 3])
