"""WARC archives as chunked record tables.

A page becomes one record. Its payload is cut into chunks of bounded size. Both directions go through a table of
chunks: a row a record id and chunk number, with the digest of all bytes so far, so that neither writing nor
reading holds a record as a whole beyond the input cell itself. A chunk is a WARC segment: the first is the
record (with the HTTP head in front of the payload), the others are ``continuation`` records that follow it in
the same file. Archives are written with Spark's text writer, whose commit protocol copes with lost executors;
the line separator is the end of a WARC record. They are compressed and so never split, which keeps the
chunks of a record in order for one reader; the reader carries the digest along and compares it at each chunk.

Of records with equal payloads of at least ``LEAST_BYTES`` bytes, that with the largest page id is the
response and the others are revisits of it, with no payload of their own; smaller ones are responses. A revisit
names the response by its record id and its target (the largest url, if the response's page has several rows).

Defined results: a null html is the empty payload; a null url is ``unknown:``; of equal payloads with
null ids only, all are responses, otherwise null ids are revisits; repeated rows of the page that is the
response are responses each; a payload that contains a record boundary is cut inside it; an empty table
gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse.sources.storage import broadcast_if_small, cut_lineage, new_path

LEAST_BYTES = 0
CHUNK_BYTES = 1 << 16
BATCH_BYTES = 1 << 22
VERSION = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
BOUNDARY = (RECORD_END + VERSION).encode()
INSIDE = len(RECORD_END) + 4  # a payload that holds a boundary is cut here in it
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Pages carry no time of their own.
CAPTURED = "2024-01-01T00:00:00Z"
CHUNKS = "record_id string, chunk int, digest_so_far string, head string, data string"
READ_BACK = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, n_chunks long, "
    "record_id string, refers_to_record string"
)
ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def cuts(payload: memoryview, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``size`` bytes that split no character and hold no record boundary."""
    n, begin = len(payload), 0
    while True:
        end = min(begin + size, n)
        while begin < end < n and payload[end] & 0xC0 == 0x80:
            end -= 1
        # the end of the head and what follows the chunk could complete a boundary
        found = (RECORD_END.encode() + bytes(payload[begin:end]) + BOUNDARY).find(BOUNDARY) - len(RECORD_END)
        if found < end - begin:
            end = begin + found + INSIDE
        yield begin, end
        begin = end
        if begin >= n:
            return


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts)))}>"


def _target(url: str | None) -> str:
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "unknown:")


def _head(record: str, fields: dict[str, object], length: int) -> str:
    lines = {"WARC-Record-ID": record, "WARC-Date": CAPTURED, **fields, "Content-Length": length}
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None) + "\r\n"


def _cut_into_chunks(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], BATCH_BYTES
        for batch in batches:
            columns = [batch[c] for c in ("page_id", "url", "html", "digest", "refers_to", "refers_url", "revisit")]
            for i in range(batch.num_rows):
                payload = memoryview(columns[2][i].as_buffer())
                page, url, refers, refers_url, revisit = (columns[c][i].as_py() for c in (0, 1, 4, 5, 6))
                digest = base32(bytes.fromhex(columns[3][i].as_py()))
                target = _target(url)
                record = _urn(page, target, digest)
                fields = {
                    "WARC-Type": "revisit" if revisit else "response",
                    "WARC-Target-URI": target,
                    "WARC-Payload-Digest": f"sha1:{digest}",
                    "Page-Id": page,
                    "Payload-Length": len(payload),
                    "Content-Type": "application/http;msgtype=response",
                }
                if revisit:
                    fields |= {
                        "WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                        "WARC-Refers-To": _urn(refers, _target(refers_url), digest),
                        "WARC-Refers-To-Target-URI": _target(refers_url),
                        "Refers-To-Page-Id": refers,
                    }
                    payload = payload[:0]
                parts = list(cuts(payload, size))
                so_far = hashlib.sha1()
                for number, (begin, end) in enumerate(parts, 1):
                    so_far.update(payload[begin:end])
                    digest_so_far = base32(so_far.digest())
                    first = HTTP_HEAD if number == 1 else b""
                    if len(parts) > 1:
                        fields |= {"WARC-Segment-Number": number, "Digest-So-Far": f"sha1:{digest_so_far}"}
                        fields |= {"WARC-Type": "continuation", "WARC-Segment-Origin-ID": record} if number > 1 else {}
                        fields |= {"WARC-Segment-Total-Length": len(HTTP_HEAD) + len(payload)} if number == len(parts) else {}
                    own = record if number == 1 else _urn(record, number)
                    data = (first + bytes(payload[begin:end])).decode("utf-8", "replace")
                    held.append((record, number, digest_so_far, _head(own, fields, len(first) + end - begin), data))
                    room -= len(data) + 512
                    if room <= 0:
                        yield _as_batch(held, CHUNKS)
                        held, room = [], BATCH_BYTES
        yield _as_batch(held, CHUNKS)

    return chunks


def chunk_table(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(record_id, chunk, digest_so_far, head, data)`` of ``pages(page_id, url, html)``; the chunks of a record are
    consecutive rows, ``head`` is the WARC head of the segment and ``data`` what follows it."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = rows.where(F.octet_length("html") >= LEAST_BYTES).select("digest", "page_id", "url")
    newest = F.max(F.struct("page_id", "url"))
    copies = large.groupBy("digest").agg(newest.alias("newest"), F.count("*").alias("n")).where("n > 1")
    copies = copies.select("digest", F.col("newest.page_id").alias("newest"), F.col("newest.url").alias("newest_url"))
    # few payloads repeat as a rule; where many do, this is a shuffled join
    typed = rows.join(broadcast_if_small(cut_lineage(copies)), "digest", "left")
    revisit = (F.octet_length("html") >= LEAST_BYTES) & F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    named = [F.when(revisit, F.col(c)).alias(name) for c, name in (("newest", "refers_to"), ("newest_url", "refers_url"))]
    return typed.select("page_id", "url", "html", "digest", *named, revisit.alias("revisit")).mapInArrow(_cut_into_chunks(chunk_bytes), CHUNKS)


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write ``pages(page_id, url, html)`` as WARC files below ``path``."""
    lines = chunk_table(pages, chunk_bytes).select(F.concat("head", "data").alias("value"))
    lines.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def read_chunk_table(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of the archives below ``path``, in the files' order: record id and chunk number, the fields of the
    head (null where it has none) and the block as ``data``, its first ``length`` bytes."""
    value = F.col("value")
    lines = spark.read.option("lineSep", BOUNDARY.decode()).text(path)
    end = F.locate("\r\n\r\n", value)
    lines = lines.where(end > 0)  # else nothing but the end of a file
    # a file's first line still has the version in front
    start = F.when(value.startswith(VERSION), len(VERSION) + 1).otherwise(1)
    parts = lines.select(
        F.concat(F.lit("\r\n"), F.substring(value, start, end - start)).alias("head"),
        F.substring(value, end + 4, F.length(value)).alias("data"),
    )
    field = lambda name: F.nullif(F.regexp_extract("head", f"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))
    return parts.select(
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("record_id"),
        F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)).alias("chunk"),
        field("Digest-So-Far").alias("digest_so_far"),
        field("WARC-Type").alias("kind"),
        field("Page-Id").cast("long").alias("page_id"),
        field("Refers-To-Page-Id").cast("long").alias("refers_to"),
        field("WARC-Refers-To").alias("refers_to_record"),
        field("WARC-Payload-Digest").alias("payload_digest"),
        field("Payload-Length").cast("long").alias("payload_bytes"),
        field("Content-Length").cast("long").alias("length"),
        "data",
    )


def _join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: dict | None = None
    rows: list[tuple] = []

    def close() -> None:
        if now is None:
            return
        response = now["kind"] == "response"
        digest = base32(now["sha"].digest()) if response else now["digest"]
        if digest != now["digest"] or now["bytes"] != now["payload_bytes"] * response:
            raise ValueError(f"record {now['record_id']} of page {now['page_id']} is damaged")
        rows.append((now["page_id"], now["payload_bytes"], digest, now["kind"], now["refers_to"], now["chunk"], now["record_id"], now["refers_to_record"]))

    for batch in batches:
        data = batch["data"]
        for i, row in enumerate(batch.drop_columns("data").to_pylist()):
            block = memoryview(data[i].as_buffer())[: row["length"]]
            if row["kind"] == "continuation":
                if now is None or now["record_id"] != row["record_id"] or now["chunk"] + 1 != row["chunk"]:
                    raise ValueError("a continuation does not follow its record")
                now["chunk"] = row["chunk"]
            else:
                close()
                block = block[bytes(block[:BATCH_BYTES]).index(b"\r\n\r\n") + 4 :]
                now = row | {"digest": row["payload_digest"].removeprefix("sha1:"), "bytes": 0, "sha": hashlib.sha1()}
            now["sha"].update(block)
            now["bytes"] += len(block)
            if row["digest_so_far"] not in (None, f"sha1:{base32(now['sha'].digest())}"):
                raise ValueError(f"record {now['record_id']} of page {now['page_id']} is damaged in chunk {now['chunk']}")
        yield _as_batch(rows, READ_BACK)
        rows.clear()
    close()
    yield _as_batch(rows, READ_BACK)


def _as_batch(rows: list[tuple], shape: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in shape.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[k]) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record below ``path``, with digest and size of the payload as read."""
    return read_chunk_table(spark, path).mapInArrow(_join_chunks, READ_BACK)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of ``pages`` in the shared folder and read them back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
