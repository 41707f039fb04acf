"""Benchmark decontamination by SimHash fingerprints of windows as long as the items.

A document is contaminated by an item if one of its windows with as many words as the item has a
weighted shingle similarity of at least 0.8 to it: common shingle occurrences over all. A document that
is shorter than an item is one window for it.

1. Items give their shingles, a 128-bit SimHash (each shingle occurrence votes on every bit) and a bit
   table of fixed size, which holds shingles and (length, shingle) pairs. The table is broadcast; its
   size is a parameter, so a larger benchmark only makes it less selective.
2. One scan of the documents finds the windows that can reach the similarity: window and item have
   ``n`` shingles each, so they must share ``2 n s / (1 + s)``, all of them in the table. These windows
   get fingerprints. Windows with the same words are one window from here on.
3. Fingerprints within ``RADIUS`` bits agree in at least one of ``RADIUS + 1`` blocks, so a join on
   length, block number and block value yields all of them. At similarity 0.8 the expected distance is
   19.5 bits with a deviation of 4.1; the radius of 31 leaves out a fraction of 2e-3 there, less above.
   A block can't be wider at this radius, and 4 bits alone let most unrelated pairs meet. So a block is
   filed under each of the rarest shingles, too: of ``n`` shingles that must have ``t`` in common with the
   other side, any ``n - t + 1`` hold one of these, here the first ones by number of items that have them.
   Texts that share no rare shingle never meet, and no pair within radius and similarity is lost.
4. Exact similarity of the candidates decides.

Defined results: null or wordless texts and items match nothing; items of equal text are separate, an
item without an id goes by a hash of its text, and so does a document without one (``text_hash``, null for
the others); repeated rows of a document are one; items of fewer than five words are one shingle, so they match
word for word only; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presspulse.llm.tokens import BASE, SHINGLE_WORDS, SIMILARITY, U, Words, mix, shingles, text_slices, weighted_jaccard, words
from presspulse.sources.storage import cut_lineage

RADIUS = 31
BLOCKS = RADIUS + 1
BLOCK_BITS = 4  # 32 blocks of 4 bits: 128 bits
TABLE_BITS = 24
RANK_BITS = 20
ITEM_COLUMNS = "item_id long, words int, bag array<long>, blocks array<int>"
PROBE_COLUMNS = "item_id long, words int, blocks array<int>, probes array<long>"
HIT_COLUMNS = "doc_id long, text_hash long, start long, words int, key long, bag array<long>, blocks array<int>, probes array<long>"


def fingerprints(bags: np.ndarray) -> np.ndarray:
    """Blocks of the SimHash of each row of shingle hashes."""
    out = np.empty((len(bags), BLOCKS), np.int32)
    for i in range(0, len(bags), 1024):
        part = bags[i : i + 1024]
        both = np.stack([mix(part + U(BASE)), mix(part ^ U(BASE))], axis=-1)
        votes = np.unpackbits(both.view(np.uint8).reshape(*part.shape, 16), axis=-1).sum(axis=1, dtype=np.int32)
        bits = (2 * votes > part.shape[1]).astype(np.int32).reshape(len(part), BLOCKS, BLOCK_BITS)
        out[i : i + 1024] = bits @ (1 << np.arange(BLOCK_BITS, dtype=np.int32))
    return out


def _slots(hashes: np.ndarray, length: int = 0, bits: int = TABLE_BITS) -> np.ndarray:
    """Places in a table of ``2 ** bits`` of shingles, or of shingles of items with ``length`` words."""
    return (mix(hashes + U((length + 1) * BASE % (1 << 64))) >> U(64 - bits)).astype(np.int64)


def common_least(sizes: int, item: int) -> int:
    """Shingles that a bag of ``sizes`` shares with one of ``item`` at the least similarity."""
    return math.ceil(SIMILARITY * (sizes + item) / (1 + SIMILARITY) - 1e-9)


def rarest(bags: np.ndarray, rank: np.ndarray, number: int) -> np.ndarray:
    """The first ``number`` elements of each row of shingle hashes, rarest first by ``rank``. A repeated
    shingle is an element each time, told apart by how often it came before."""
    out = np.empty((len(bags), number), U)
    place = np.arange(bags.shape[1])
    for i in range(0, len(bags), 1024):
        part = bags[i : i + 1024]
        order = np.lexsort((part, rank[_slots(part, bits=RANK_BITS)]), axis=-1)
        part = np.take_along_axis(part, order, axis=1)
        new = np.ones(part.shape, bool)
        new[:, 1:] = part[:, 1:] != part[:, :-1]
        before = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
        out[i : i + 1024] = mix(part + before.astype(U) * U(BASE))[:, :number]
    return out


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    sizes = np.cumsum([0, *(len(r) for r in rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(sizes, pa.array(np.concatenate([np.zeros(0, np.int64), *rows]).astype(kind.to_pandas_dtype())))


def _fingerprint_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole):
            found = words(batch["text"])
            bag = shingles(found)
            ends = np.cumsum(bag.count)
            at = np.flatnonzero(bag.count)
            rows = [bag.hash[ends[i] - bag.count[i] : ends[i]] for i in at]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["item_id"].take(pa.array(at, pa.int64())).cast(pa.int64()),
                    pa.array(found.count[at].astype(np.int32)),
                    _lists([r.view(np.int64) for r in rows], pa.int64()),
                    _lists([fingerprints(r[None, :])[0] for r in rows], pa.int32()),
                ],
                names=["item_id", "words", "bag", "blocks"],
            )


def _table_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for length, bag in zip(batch["words"].to_pylist(), batch["bag"], strict=True):
            h = np.array(bag.values).view(U)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_slots(h), _slots(h, length)]))], names=["slot"])


def _rank_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bag in batch["bag"]:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slots(np.array(bag.values).view(U), bits=RANK_BITS)))], names=["slot"])


def _tables(slots: DataFrame, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each ``level`` of ``slots(level, slot)`` the places taken, as booleans; ``2 ** bits`` each."""
    slot = F.col("slot") + 1
    pages = slots.groupBy("level", F.bitmap_bucket_number(slot).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    tables: dict[int, np.ndarray] = {}
    for row in pages.collect():  # a level takes at most 2 ** bits bits
        found = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little").astype(bool)
        table = tables.setdefault(row.level, np.zeros(1 << bits, bool))
        part = table[(row.page - 1) * len(found) : row.page * len(found)]
        part[:] = found[: len(part)]
    yield from sorted(tables.items())


def bit_table(items: DataFrame) -> np.ndarray:
    """The places that the items' shingles take, as booleans; ``2 ** TABLE_BITS`` whatever the items."""
    slots = items.mapInArrow(_table_slots, "slot long").select(F.lit(0).alias("level"), "slot")
    return next((table for _, table in _tables(slots, TABLE_BITS)), np.zeros(1 << TABLE_BITS, bool))


def rank_table(items: DataFrame) -> np.ndarray:
    """How common shingles are: by place the logarithm of the number of items, from 1, and 0 where no item has
    one; ``2 ** RANK_BITS`` bytes whatever the items."""
    counts = items.mapInArrow(_rank_slots, "slot long").groupBy("slot").count()
    rank = np.zeros(1 << RANK_BITS, np.uint8)
    for level, table in _tables(counts.select((F.floor(F.log2("count")) + 1).cast("int").alias("level"), "slot"), RANK_BITS):
        rank[table] = level
    return rank


def _item_probes(ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(ranks.value, np.uint8)
        for batch in batches:
            rows = []
            for bag in batch["bag"]:
                h = np.array(bag.values).view(U)
                least = common_least(math.ceil(SIMILARITY * len(h) - 1e-9), len(h))  # with the shortest text that can match
                rows.append(rarest(h[None, :], rank, len(h) - least + 1)[0].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["item_id"], batch["words"], batch["blocks"], _lists(rows, pa.int64())], names=["item_id", "words", "blocks", "probes"])

    return scan


def _runs(found: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each place, as ``shingles`` has them; first and number of each text's."""
    count = np.maximum(found.count - k + 1, 0)
    first = np.cumsum(count) - count
    starts = np.repeat(np.cumsum(found.count) - found.count - first, count) + np.arange(count.sum())
    total = np.zeros(len(starts), U)
    for j in range(k):
        total += found.hash[starts + j] * U(pow(BASE, j + 1, 1 << 64))
    return mix(total + U(k if k < SHINGLE_WORDS else 0)), first, count


def windows(found: Words, lengths: list[int], table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length in words: texts, first words and shingle bags of the windows that can match."""
    for k in sorted({min(n, SHINGLE_WORDS) for n in lengths}):
        hashes, first, count = _runs(found, k)
        known = np.flatnonzero(table[_slots(hashes)])
        if not len(known):
            continue
        doc = np.searchsorted(first + count, known, side="right")
        for length in lengths:
            if min(length, SHINGLE_WORDS) != k:
                continue
            n = length - k + 1
            some = table[_slots(hashes[known], length)]
            at, of = known[some], doc[some]
            need = common_least(n, n)
            near = np.flatnonzero((at[need - 1 :] - at[: len(at) - need + 1] < n) & (of[need - 1 :] == of[: len(of) - need + 1])) if len(at) >= need else at[:0]
            if len(near):
                low = np.maximum(at[near + need - 1] - n + 1, first[of[near]])
                high = np.minimum(at[near], first[of[near]] + count[of[near]] - n)
                held = np.maximum(high - low + 1, 0)
                starts = np.unique(np.repeat(low - np.cumsum(held) + held, held) + np.arange(held.sum()))
                if len(starts):
                    texts = np.searchsorted(first + count, starts, side="right")
                    yield length, texts, starts - first[texts], hashes[starts[:, None] + np.arange(n)]
            hits = np.bincount(of, minlength=len(count))
            for d in np.flatnonzero((hits > 0) & (count < n) & (count >= SIMILARITY * n)):
                if hits[d] * (1 + SIMILARITY) >= SIMILARITY * (count[d] + n) - 1e-9:
                    yield length, np.array([d]), np.array([0]), hashes[None, first[d] : first[d] + count[d]]


def _window_hits(lengths: list[int], packed, ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.frombuffer(packed.value, np.uint8)).view(bool)
        rank = np.frombuffer(ranks.value, np.uint8)
        for whole in batches:
            for batch in text_slices(whole):
                for length, texts, starts, bags in windows(words(batch["text"]), lengths, table):
                    place = np.arange(1, bags.shape[1] + 1, dtype=U) * U(BASE)
                    keys = mix(mix(bags + place).sum(axis=1, dtype=U))
                    _, once = np.unique(keys, return_index=True)
                    size, item = bags.shape[1], length - min(length, SHINGLE_WORDS) + 1
                    rare = rarest(bags[once], rank, size - common_least(size, item) + 1).view(np.int64)
                    bag, blocks, probes = ([None] * len(keys) for _ in range(3))
                    for i, b, r in zip(once, fingerprints(bags[once]), rare, strict=True):  # the content of a window goes once
                        bag[i], blocks[i], probes[i] = bags[i].view(np.int64), b, r
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch[c].take(pa.array(texts, pa.int64())).cast(pa.int64()) for c in ("doc_id", "text_hash")),
                            pa.array(starts.astype(np.int64)),
                            pa.array(np.full(len(keys), length, np.int32)),
                            pa.array(keys.view(np.int64)),
                            pa.array(bag, pa.list_(pa.int64())),
                            pa.array(blocks, pa.list_(pa.int32())),
                            pa.array(probes, pa.list_(pa.int64())),
                        ],
                        names=["doc_id", "text_hash", "start", "words", "key", "bag", "blocks", "probes"],
                    )

    return scan


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch["bag"], batch["item_bag"], strict=True)
        exact = np.array([weighted_jaccard(np.array(a.values), np.array(b.values)) for a, b in pairs], float)
        held = pa.array(exact >= SIMILARITY)
        yield pa.RecordBatch.from_arrays(
            [*(batch[c].filter(held) for c in ("words", "key", "item_id")), pa.array(exact).filter(held)],
            names=["words", "key", "item_id", "similarity"],
        )


def _filed(rows: DataFrame, *columns: str) -> DataFrame:
    """A row for each block and rare shingle; ``place`` is a hash of length, block number, block and shingle."""
    blocks = rows.select(*columns, "probes", F.posexplode("blocks").alias("block", "value"))
    return blocks.select(*columns, "block", "value", F.explode("probes").alias("probe")).select(*columns, F.xxhash64("words", "block", "value", "probe").alias("place"))


def candidates(found: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs ``(words, key, item_id)`` of windows and items that have a block and a rare shingle in common."""
    return _filed(found, "words", "key").join(_filed(items, "words", "item_id").drop("words"), "place").select("words", "key", "item_id").distinct()


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, similarity, start, words, windows, text_hash)``, a row for each contaminated pair.

    ``similarity`` is that of the best window, ``start`` the number of words before it (the first of
    the best ones), ``words`` the length of the item and ``windows`` the number of matching places.
    """
    context = docs.sparkSession.sparkContext
    items = cut_lineage(benchmark.select(F.coalesce("item_id", F.xxhash64("text")).alias("item_id"), "text").mapInArrow(_fingerprint_items, ITEM_COLUMNS))
    lengths = sorted(r.words for r in items.select("words").distinct().collect())  # at most the longest item's words
    packed = context.broadcast(np.packbits(bit_table(items)).tobytes())
    ranks = context.broadcast(rank_table(items).tobytes())
    texts = docs.select("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("text_hash"), "text")
    hits = cut_lineage(texts.mapInArrow(_window_hits(lengths, packed, ranks), HIT_COLUMNS))
    found = hits.where("bag is not null").dropDuplicates(["words", "key"]).select("words", "key", "bag", "blocks", "probes")
    met = candidates(found, items.mapInArrow(_item_probes(ranks), PROBE_COLUMNS))
    apart = F.aggregate(F.zip_with("blocks", "item_blocks", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    matches = (
        met.join(found.drop("probes"), ["words", "key"])
        .join(items.select("item_id", F.col("words").alias("item_words"), F.col("bag").alias("item_bag"), F.col("blocks").alias("item_blocks")), "item_id")
        .where(F.col("words") == F.col("item_words"))
        .where(apart <= RADIUS)
        .select("words", "key", "item_id", "bag", "item_bag")
        .mapInArrow(_similarity, "words int, key long, item_id long, similarity double")
        .distinct()
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back")))
    return (
        hits.select("doc_id", "text_hash", "start", "words", "key")
        .join(matches, ["words", "key"])
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(best.alias("best"), F.max("words").alias("words"), F.countDistinct("start").alias("windows"))
        .select("doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "words", "windows", "text_hash")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = contaminations(docs, benchmark).select("doc_id", "text_hash").distinct()
    text_hash = F.when(docs["doc_id"].isNull(), F.xxhash64(docs["text"]))
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & text_hash.eqNullSafe(bad["text_hash"])
    return docs.join(bad, same, "left_anti").select(*docs.columns)
