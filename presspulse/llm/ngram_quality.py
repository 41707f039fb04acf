"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over the bytes of the UTF-8 text, of order ``ORDER``: an n-gram is a number of 8 bits a symbol,
so keys are exact and suffixes and contexts are arithmetic. It is trained on documents labelled as good,
except a fifth of them held out by a hash of the id. All counts are tables sharded by n-gram:

1. Each task adds up the n-grams of its trusted texts; each shard adds up what tasks counted. Numbers of different
   symbols before each shorter n-gram (continuation counts) and the sums of each context follow by group-bys
   of the table of the next order. Discounts come from the counts of counts of each order.
2. Documents are cut into chunks of about ``CHUNK_BYTES``; each chunk states its different n-grams to their
   shards. The different n-grams of all chunks are joined with the count tables, from the lowest order up,
   which gives their interpolated probabilities, and each shard answers the chunks that asked.
3. A chunk and its probabilities meet in one task, which adds up the logarithms of each document.

So what is moved, beside the compressed chunks, grows with the chunks and with the different n-grams, not with
tokens. The ids of the trusted documents are broadcast up to a checked number; beyond it, texts and ids meet in
a shuffled join with the same result. N-grams travel sorted, as compressed differences. The number of shards
grows with that of chunks, so that a shard's questions stay within a task's memory. A chunk is named by a hash of its ids and texts, so that both readings of the documents agree even if
tasks are repeated.

A document is kept if its perplexity per byte is at most the ``QUANTILE`` quantile of the held-out trusted
documents of its language (of all languages where its own has none held out).

Defined results: null and empty texts have no perplexity and are not kept; null languages are a language of
their own; without trusted text, or none held out, there is no threshold and documents with text are kept;
repeated rows get their own results; of several labels a bad one holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presspulse.llm.tokens import text_slices, utf8
from presspulse.sources.storage import broadcast_if_small, cut_lineage

ORDER = 5
QUANTILE = 0.99
CHUNK_BYTES = 1 << 25
PIECE_BYTES = 1 << 20
ACCURACY = 100_000
SPREAD = 1_000_003  # a prime: the shard of an n-gram is its remainder by this, by the number of shards
LEAST_SHARDS, CHUNKS_A_SHARD = 16, 16
MAX_BROADCAST_IDS = 1_000_000  # ids of trusted documents; more of them meet the documents in a shuffled join


def grams(texts: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of all texts, with zero bytes before each text; ends of the texts."""
    data, offsets = utf8(texts)
    keys = data.astype(np.int64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(1, order):
        earlier = np.zeros(len(data), np.int64)
        earlier[back:] = data[:-back] if back < len(data) else 0
        keys |= np.where(place >= back, earlier, 0) << (8 * back)
    return keys, offsets


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, at = np.unique(keys, return_inverse=True)
    return known, np.bincount(at, weights=counts, minlength=len(known)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    keys, counts, held, pending = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    for whole in batches:
        for batch in text_slices(whole, limit=PIECE_BYTES):
            held.append(np.unique(grams(batch["text"])[0], return_counts=True))
            pending += len(held[-1][0])
            if pending > 4_000_000:  # memory stays with the different n-grams
                keys, counts = _merge(np.concatenate([keys, *(k for k, _ in held)]), np.concatenate([counts, *(c for _, c in held)]))
                held, pending = [], 0
    keys, counts = _merge(np.concatenate([keys, *(k for k, _ in held)]), np.concatenate([counts, *(c for _, c in held)]))
    yield _by_shard(keys, shards, {"counts": counts})


def _squeeze(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(values.tobytes())


def _open(blob: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), kind)


def _open_keys(blob: pa.Scalar) -> np.ndarray:
    return np.cumsum(_open(blob, np.int64))


def _by_shard(keys: np.ndarray, shards: int, values: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each shard with its part of the sorted keys, as differences, and of the values."""
    of = keys % SPREAD % shards
    rows = [np.flatnonzero(of == i) for i in range(shards)] if shards <= 64 else np.split(o := np.argsort(of, kind="stable"), np.searchsorted(of[o], np.arange(1, shards)))
    held = [(i, r) for i, r in enumerate(rows) if len(r)]
    columns = {"shard": pa.array([i for i, _ in held], pa.int64()), "keys": pa.array([_squeeze(np.diff(keys[r], prepend=0)) for _, r in held], pa.binary())}
    columns |= {name: pa.array([_squeeze(v[r]) for _, r in held], pa.binary()) for name, v in values.items()}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _add_up(group: pa.Table) -> pa.Table:
    """Counts of the n-grams of a shard."""
    pairs = [(_open_keys(k), _open(c, np.int64)) for k, c in zip(group["keys"], group["counts"], strict=True)]
    keys, counts = _merge(np.concatenate([k for k, _ in pairs]), np.concatenate([c for _, c in pairs]))
    return pa.table({"gram": keys, "n": counts})


def _different(group: pa.Table) -> pa.Table:
    """The n-grams that any chunk asks of a shard."""
    return pa.table({"gram": np.unique(np.concatenate([_open_keys(k) for k in group["keys"]]))})


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """For each question to a shard, the probabilities of its n-grams."""
    order = np.argsort(known["gram"].to_numpy())
    keys, logp = known["gram"].to_numpy()[order], known["logp"].to_numpy()[order]
    out = []
    for blob in asked["keys"]:
        own = _open_keys(blob)
        at = np.searchsorted(keys, own)
        if len(own) and (at.max() >= len(keys) or (keys[at] != own).any()):
            raise ValueError("an n-gram of a chunk has no probability")
        out.append(_squeeze(logp[at]))
    return pa.table({"chunk": asked["chunk"], "keys": asked["keys"], "logp": pa.array(out, pa.binary())})


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (8 * order)) - 1))


def _context(gram: Column) -> Column:
    return F.shiftright(gram, 8)


class Model:
    """Count tables by order (``gram``, ``n``) and context tables (``context``, ``total``, ``n1``, ``n2``, ``n3``)."""

    def __init__(self, counts: DataFrame, order: int = ORDER):
        self.order = order
        self.counts, self.contexts, self.discounts = {}, {}, {}
        for m in range(order, 0, -1):
            self.counts[m] = cut_lineage(counts)
            of_count = {r.c: r["count"] for r in self.counts[m].groupBy(F.least("n", F.lit(5)).alias("c")).count().collect()}
            n1, n2, n3, n4 = (of_count.get(i, 0) for i in range(1, 5))
            y = n1 / (n1 + 2 * n2) if n1 else 0.5
            raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
            self.discounts[m] = [min(max(d, 0.0), float(i)) for i, d in enumerate(raw, 1)]
            exactly = lambda i: F.sum((F.col("n") == i).cast("long"))
            self.contexts[m] = self.counts[m].groupBy(_context(F.col("gram")).alias("context")).agg(
                F.sum("n").alias("total"), exactly(1).alias("n1"), exactly(2).alias("n2"), F.sum((F.col("n") > 2).cast("long")).alias("n3")
            )
            counts = self.counts[m].groupBy(_suffix(F.col("gram"), m - 1).alias("gram")).agg(F.count("*").alias("n")) if m > 1 else None

    def probabilities(self, keys: DataFrame) -> DataFrame:
        """``keys(gram)`` with the log probability of the last byte after the others."""
        rows = keys.select("gram", F.lit(1.0 / 256).alias("p"))
        for m in range(1, self.order + 1):
            own = _suffix(F.col("gram"), m)
            d1, d2, d3 = self.discounts[m]
            met = (
                rows.select("gram", "p", own.alias("own"), _context(own).alias("context"))
                .join(self.counts[m].select(F.col("gram").alias("own"), "n"), "own", "left")
                .join(self.contexts[m], "context", "left")
            )
            n = F.coalesce("n", F.lit(0))
            kept = n - F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)
            spread = d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")
            p = F.when(F.col("total").isNull(), F.col("p")).otherwise((kept + spread * F.col("p")) / F.col("total"))
            rows = met.select("gram", p.alias("p"))
        return rows.select("gram", F.log("p").alias("logp"))


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held)`` of the documents labelled good; ``held`` marks those left out of training."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return good.where("q = 1 and t = 0").select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(5)) == 0).alias("held"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive documents of about ``CHUNK_BYTES``."""
    held, size = [], 0
    for whole in batches:
        for batch in text_slices(whole, limit=CHUNK_BYTES // 8):
            held.append(batch)
            size += pc.sum(pc.binary_length(batch["text"])).as_py() or 0
            if size >= CHUNK_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _name(batch: pa.RecordBatch) -> int:
    data, offsets = utf8(batch["text"])
    ids = batch["doc_id"].fill_null(-1).to_numpy(zero_copy_only=False)
    return xxhash.xxh64_intdigest(offsets.tobytes() + ids.tobytes(), seed=xxhash.xxh32_intdigest(data.tobytes())) - (1 << 63)


def _needs(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches):
        keys = np.zeros(0, np.int64)
        for piece in text_slices(chunk, limit=PIECE_BYTES):
            keys = np.union1d(keys, grams(piece["text"])[0])
        asked = _by_shard(keys, shards, {})
        yield pa.RecordBatch.from_arrays([pa.array(np.full(asked.num_rows, _name(chunk))), *asked.columns], names=["chunk", *asked.schema.names])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=6)
    for chunk in _chunks(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, chunk.schema) as out:
            out.write_batch(chunk)
        blob = squeeze.compress(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array([_name(chunk)]), pa.array([blob], pa.binary())], names=["chunk", "blob"])


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob, known in zip(batch["blob"], batch["known"], strict=True):
            chunk = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob.as_py())).read_next_batch()
            answers = known.values
            keys = np.concatenate([np.zeros(0, np.int64), *map(_open_keys, answers.field("keys"))])
            logp = np.concatenate([np.zeros(0), *(_open(x, np.float64) for x in answers.field("logp"))])
            order = np.argsort(keys)
            keys, logp = keys[order], logp[order]
            for piece in text_slices(chunk, limit=PIECE_BYTES):
                own, offsets = grams(piece["text"])
                at = np.searchsorted(keys, own)
                if len(own) and (at.max() >= len(keys) or (keys[at] != own).any()):
                    raise ValueError("an n-gram of a chunk has no probability")
                sums = np.concatenate([[0.0], np.cumsum(logp[at])])
                n = np.diff(offsets)
                total = sums[offsets[1:]] - sums[offsets[:-1]]
                perplexity = pa.array(np.exp(-total / np.maximum(n, 1)), mask=n == 0)
                yield pa.RecordBatch.from_arrays([piece["doc_id"], piece["lang"], pa.array(n), perplexity], names=["doc_id", "lang", "n_bytes", "perplexity"])


def shard_count(parts: int) -> int:
    return max(LEAST_SHARDS, math.ceil(parts / CHUNKS_A_SHARD))


def perplexities(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang, n_bytes, perplexity)`` for each row of ``docs(doc_id, lang, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    chunks = math.ceil((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / CHUNK_BYTES)
    shards = shard_count(chunks)
    # few files of little text would else state the same n-grams again and again
    rows = rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, chunks))
    asked = cut_lineage(rows.mapInArrow(lambda x: _needs(x, shards), "chunk long, shard long, keys binary"))
    grams_asked = asked.select("shard", "keys").groupBy("shard").applyInArrow(_different, "gram long")
    known = model.probabilities(cut_lineage(grams_asked)).select((F.col("gram") % SPREAD % shards).alias("shard"), "gram", "logp")
    answers = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_answer, "chunk long, keys binary, logp binary")
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("keys", "logp")).alias("known"))  # one of each shard at most
    packed = rows.mapInArrow(_pack, "chunk long, blob binary")
    none = F.array().cast("array<struct<keys:binary,logp:binary>>")
    met = packed.join(answers.hint("shuffle_hash"), "chunk", "left").select("blob", F.coalesce("known", none).alias("known"))
    return met.mapInArrow(_score, "doc_id long, lang string, n_bytes long, perplexity double")


def _threshold() -> Column:
    """The limit from the perplexities of held-out documents."""
    return F.percentile_approx("perplexity", F.lit(QUANTILE), F.lit(ACCURACY))


def perplexity_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, lang, n_bytes, perplexity, threshold, kept)`` for each row of ``docs``."""
    good = cut_lineage(trusted(docs, labels))
    ids = broadcast_if_small(good.where("not held").select("doc_id"), MAX_BROADCAST_IDS)
    training = docs.select("doc_id", "text").where("text <> ''").join(ids, "doc_id", "left_semi").select("text")
    shards = shard_count(docs.rdd.getNumPartitions())
    counted = training.mapInArrow(lambda x: _count(x, shards), "shard long, keys binary, counts binary")
    model = Model(counted.groupBy("shard").applyInArrow(_add_up, "gram long, n long"))
    scored = cut_lineage(perplexities(docs, model))
    held = scored.where("perplexity is not null").join(good.where("held"), "doc_id", "left_semi")
    limit = lambda rows: rows.agg(_threshold().alias("threshold"))
    by_lang = limit(held.groupBy(F.coalesce("lang", F.lit("")).alias("l")))
    overall = limit(held.groupBy()).first()[0]
    out = scored.withColumn("l", F.coalesce("lang", F.lit(""))).join(by_lang, "l", "left")
    out = out.withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
    kept = F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))
    return out.select("doc_id", "lang", "n_bytes", "perplexity", "threshold", kept.alias("kept"))
