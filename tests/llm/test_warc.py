from __future__ import annotations

import base64
import collections
import gzip
import hashlib
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presspulse.llm.warc import BOUNDARY, chunk_table, cuts, read_archives, read_chunk_table, round_trip, write_archives

PAGES = "page_id long, url string, html string, digest string, revisit int, newest string, value string"
EDGE = "\r\n\r\nWARC/1.0\r\n"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, "n", "v") for i, u, h in rows], PAGES)


ROWS = [
    (1, "http://a/", None), (2, "u", "dup"), (3, None, "dup"), (9, "x", "dup"), (9, "x", "dup"), (None, "x", "dup"), (None, "y", "only"),
    (4, "a b\r\nc", "A" * 70_000 + EDGE + "é" * 100_000 + EDGE + "WARC/1.0\r\n" + EDGE), (5, "", ""), (6, "q", "x" * 65_530 + EDGE + "z"),
    (7, "q", "\r\n\r\n"), (8, "q", "😀" * 40_000 + "\r\n\r\nWARC"), (10, "é", EDGE * 3), (11, "r", "WARC/1.0\r\nWARC-Type: response\r\n\r\n"),
]


def expected(rows):
    newest = {}
    for i, _, h in rows:
        newest[h or ""] = max(newest.get(h or "", -1), -1 if i is None else i)
    out = collections.Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        top = newest[h or ""]
        first = i == top or top < 0
        out[i, len(data), digest, "response" if first else "revisit", None if first else top] += 1
    return out


@pytest.mark.parametrize("size", [None, 16])
def test_round_trip(spark, tmp_path, size):
    rows = ROWS if size is None else [r for r in ROWS if len(r[2] or "") < 100]
    if size:
        write_archives(pages(spark, rows), f"{tmp_path}/w", size)
    got = read_archives(spark, f"{tmp_path}/w") if size else round_trip(pages(spark, rows))
    rows_back = got.collect()
    assert collections.Counter(tuple(r)[:5] for r in rows_back) == expected(rows)
    assert max(r.n_chunks for r in rows_back) > 1
    responses = {r.record_id: r.page_id for r in rows_back if r.record_type == "response"}
    for r in rows_back:  # a reference is the id of a record that exists
        assert (r.refers_to_record is not None) == (r.record_type == "revisit")
        assert r.refers_to_record is None or responses[r.refers_to_record] == r.refers_to


def test_chunk_tables_of_both_directions_agree(spark, tmp_path):
    rows = [(1, "a", "x" * 95), (2, "b", "é" * 60), (3, None, None), (4, "c", "x" * 95)]
    write_archives(pages(spark, rows), f"{tmp_path}/w", 20)
    wrote = chunk_table(pages(spark, rows), 20).collect()
    back = read_chunk_table(spark, f"{tmp_path}/w").collect()
    assert sorted((r.record_id, r.chunk) for r in wrote) == sorted((r.record_id, r.chunk) for r in back)
    so_far = {(r.record_id, r.chunk): r.digest_so_far for r in wrote}
    assert all(r.digest_so_far in (None, f"sha1:{so_far[r.record_id, r.chunk]}") for r in back)
    chunks = [r for r in wrote if "\nPage-Id: 4\r" in r.head]
    assert [r.chunk for r in chunks] == [1, 2, 3, 4, 5]
    assert chunks[2].digest_so_far == base64.b32encode(hashlib.sha1(b"x" * 60).digest()).decode()
    (revisit,) = [r for r in wrote if "WARC-Type: revisit" in r.head]
    assert "WARC-Refers-To-Target-URI: c\r\n" in revisit.head and f"WARC-Refers-To: {chunks[0].record_id}\r\n" in revisit.head


def test_files_are_warc(spark, tmp_path):
    write_archives(pages(spark, ROWS).coalesce(1), f"{tmp_path}/w", 1000)
    (path,) = Path(f"{tmp_path}/w").glob("part-*.gz")
    data, n = gzip.decompress(path.read_bytes()), 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.0\r\n") and {"WARC-Type", "WARC-Record-ID", "WARC-Date"} <= set(fields)
        length = int(fields["Content-Length"])
        assert rest[length : length + 4] == b"\r\n\r\n"
        data, n = rest[length + 4 :], n + 1
    assert n > len(ROWS)


def test_damage_is_found(spark, tmp_path):
    write_archives(pages(spark, [(1, "u", "payload text")]).coalesce(1), f"{tmp_path}/w")
    (path,) = Path(f"{tmp_path}/w").glob("part-*.gz")
    text = gzip.decompress(path.read_bytes()).replace(b"payload text", b"payload tixt").decode()
    spark.createDataFrame([(text[:-4],)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(f"{tmp_path}/x")
    with pytest.raises(Exception, match="damaged"):
        read_archives(spark, f"{tmp_path}/x").collect()


@given(st.lists(st.sampled_from(["a", "é", "😀", EDGE, "\r\n", "WARC"]), max_size=30).map("".join), st.integers(4, 40))
@settings(max_examples=300, deadline=None)
def test_cuts(text, size):
    payload = memoryview(text.encode())
    parts = [bytes(payload[b:e]) for b, e in cuts(payload, size)]
    assert b"".join(parts) == bytes(payload)
    for p in parts:
        assert len(p) <= size and (b"\r\n\r\n" + p + BOUNDARY).index(BOUNDARY) == 4 + len(p)
        p.decode()


def test_empty_table(spark):
    assert round_trip(pages(spark, [])).count() == 0
