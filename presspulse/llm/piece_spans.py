"""Encoding with a SentencePiece model that keeps the source bytes of every piece.

Normalisation goes through the character map compiled into the model: at each place the longest prefix
found in its double-array trie is replaced, any other character stays, and every byte written remembers
the source byte at which its unit began. Blank rules of the model (dummy prefix, extra blanks, escaped
blanks) act on that stream and keep the memory aligned. The model's merges then split the normalised
text into pieces, whose byte lengths walk over the memory and give the source span of each piece. An
unknown character becomes one piece a byte: the last one holds its span, those before are empty at its
beginning.

Of encoding, the library does the merges only: it is loaded with the model's pieces and a normaliser that
changes nothing. Decoding is the library's. Texts are whole; a task holds one text's arrays at a time. Nothing is shuffled, so a lost task
is done again from the scan.

Defined results: null and empty texts have no pieces; bytes that are not UTF-8 are read as U+FFFD;
repeated rows are encoded each; rows with a null id keep it; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presspulse.llm.tokens import text_slices

MODEL = "piece_bpe_32k.model"
BLANK = "▁".encode()
#: Field numbers of the model file.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
BLANK_AS_SUFFIX = 24
#: A normaliser that leaves texts alone; appended to a model, it replaces the model's settings.
NO_CHANGE = bytes([NORMALIZER << 3 | 2, 8, CHARACTER_MAP << 3 | 2, 0, DUMMY_PREFIX << 3, 0, REMOVE_EXTRA << 3, 0, ESCAPE << 3, 0])
ENCODED = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string"
SLICE = 1 << 21


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift += 7
        at += 1
        if data[at - 1] < 128:
            return value, at


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one serialised message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """Longest-prefix replacement through a compiled character map: a double-array trie over UTF-8 bytes,
    and the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64)
        self.strings = np.frombuffer(blob[4 + size :], np.uint8)
        self.ends = np.flatnonzero(self.strings == 0)

    def longest(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest entry at each start, 0 for none, and where its replacement begins."""
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        live = np.arange(len(starts)) if len(self.units) else np.arange(0)
        offset = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node = np.full(len(live), offset(self.units[0]) if len(live) else 0)
        step = 0
        while len(live):
            inside = starts[live] + step < len(data)
            live, node = live[inside], node[inside]
            byte = data[starts[live] + step].astype(np.int64)
            node = node ^ byte
            unit = self.units[np.minimum(node, len(self.units) - 1)]
            found = (node < len(self.units)) & (unit & (1 << 31 | 255) == byte)
            live, unit = live[found], unit[found]
            node = node[found] ^ offset(unit)
            step += 1
            leaf = unit >> 8 & 1 == 1
            length[live[leaf]] = step
            value[live[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
        return length, value

    def units_of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Units of a text from left to right: source start, and place and length of what replaces each
        in ``data`` followed by the replacements; last, which of them are entries."""
        starts = np.flatnonzero(data & 0xC0 != 0x80)
        ends = np.append(starts[1:], len(data))
        length, value = self.longest(data, starts)
        entry = length > 0
        kept = np.ones(len(starts), bool)
        done = 0
        for i in np.flatnonzero(length > ends - starts):  # entries of several characters hide those after their first
            if starts[i] >= done:
                done = starts[i] + length[i]
                kept[i + 1 : np.searchsorted(starts, done)] = False
        starts, ends, value, entry = starts[kept], ends[kept], value[kept], entry[kept]
        place = np.where(entry, len(data) + value, starts)
        size = ends - starts
        size[entry] = self.ends[np.searchsorted(self.ends, value[entry])] - value[entry]
        return starts, place, size, entry


class PieceEncoder:
    """Pieces and source spans by one model. ``model`` is a serialised model."""

    def __init__(self, model: bytes):
        fields: dict[int, list] = {TRAINER: [], NORMALIZER: []}
        for number, value in message(model):
            if number in fields:
                fields[number].append(value)
        setting = {k: v for part in fields[NORMALIZER] for k, v in message(part)}
        trainer = {k: v for part in fields[TRAINER] for k, v in message(part)}
        self.map = CharacterMap(setting.get(CHARACTER_MAP, b""))
        self.prefix, self.remove_extra, self.escape = (bool(setting.get(k, 1)) for k in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE))
        self.suffix = bool(trainer.get(BLANK_AS_SUFFIX, 0))
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=model + NO_CHANGE, num_threads=1)
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model, num_threads=1)

    @cached_property
    def lengths(self) -> np.ndarray:
        """Bytes of the normalised text that each id stands for; -1 where that depends on the text."""
        names = [self.merges.id_to_piece(i) for i in range(self.merges.get_piece_size())]
        sizes = [1 if self.merges.is_byte(i) else len(p.encode()) for i, p in enumerate(names)]
        return np.array([-1 if self.merges.is_unknown(i) else n for i, n in enumerate(sizes)])

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.merges.is_byte(i) for i in range(self.merges.get_piece_size())])

    def normalize(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source byte it comes from."""
        data = np.frombuffer(text, np.uint8)
        starts, place, size, entry = self.map.units_of(data)
        first = np.cumsum(size) - size
        within = np.arange(size.sum()) - np.repeat(first, size)
        out = np.concatenate([data, self.map.strings])[np.repeat(place, size) + within] if entry.any() else data
        align = np.repeat(starts, size)
        begin, end = 0, len(text)
        if self.remove_extra:
            blank = out == 32
            lone = np.zeros(len(starts), bool)
            lone[size == 1] = blank[first[size == 1]]
            begin = int(starts[~lone][0]) if not lone.all() else end
            head = np.cumsum(~blank)  # a blank at the head of its unit has no other byte of the unit before it
            head = blank & (head == np.repeat(np.where(first > 0, np.append(0, head)[first], 0), size))
            before = np.repeat(np.where(first > 0, np.append(True, blank)[first], True), size)
            held = ~(head & before)
            out, align = out[held], align[held]
        if begin == end:
            return b"", np.array([end])
        if self.escape and (blank := out == 32).any():
            widths = np.where(blank, len(BLANK), 1)
            out, align = np.repeat(out, widths), np.repeat(align, widths)
            at = np.cumsum(widths)[blank] - len(BLANK)
            for i, byte in enumerate(BLANK):
                out[at + i] = byte
        done, mark = out.tobytes(), BLANK if self.escape else b" "
        if self.prefix and not self.suffix:
            done, align = mark + done, np.concatenate([np.full(len(mark), begin), align])
        if self.remove_extra:
            size = len(done)
            while done[:size].endswith(mark):
                size -= len(mark)
            if size < len(done):
                end = int(align[size])
                done, align = done[:size], align[:size]
        if self.prefix and self.suffix:
            done, align = done + mark, np.concatenate([align, np.full(len(mark), end)])
        return done, np.append(align, end)

    def spans(self, normal: bytes, align: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte spans of the pieces of a normalised text."""
        lengths = self.lengths[ids]
        if (lengths < 0).any():  # runs of unknown characters, without pieces for bytes
            lengths = np.array([len(p.encode()) for p in self.merges.encode(normal.decode(), return_type=str)])
        after = np.cumsum(lengths)
        before = after - lengths
        starts, ends = align[before], align[after]
        if (byte := self.byte_ids[ids]).any():
            lead = np.flatnonzero(np.frombuffer(normal, np.uint8) & 0xC0 != 0x80)
            which = np.searchsorted(lead, before[byte], side="right")
            following = np.append(lead, len(normal))[which]
            starts[byte] = align[lead[which - 1]]
            ends[byte] = np.where(after[byte] == following, align[following], starts[byte])
        return starts, ends

    def encode(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, starts and ends of the pieces of each text."""
        normal = [self.normalize(t) for t in texts]
        for (done, align), ids in zip(normal, self.merges.encode([n.decode() for n, _ in normal], return_type="numpy"), strict=True):
            yield ids, *self.spans(done, align, ids)


def load(path: str) -> PieceEncoder:
    """The encoder of a model file; tasks of one worker process share it."""
    known = sentencepiece.__dict__.setdefault("_loaded_models", {})  # by way of the module, which is not shipped with the task
    if path not in known:
        with open(path, "rb") as f:
            known[path] = PieceEncoder(f.read())
    return known[path]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32))


def _encode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for whole in batches:
            for batch in text_slices(whole, limit=SLICE):
                texts = [t.as_py() or b"" for t in batch["text"].cast(pa.binary())]
                done = [*encoder.encode(texts)]
                decoded = encoder.decoder.decode([ids for ids, _, _ in done]) if done else []
                columns = [batch["doc_id"], *map(_lists, zip(*done, strict=True)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ENCODED.split(", ")])

    return encode


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """A row for each document: ids, the byte spans of its text that the pieces stand for, and what the
    ids decode to. ``model`` is the path of a model file on the executors."""
    path = model or public_tokenizers.path(MODEL)
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.make_valid_utf8(docs["text"]).alias("text"))
    return read.mapInArrow(_encode(path), ENCODED)


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Counts and checksums of ``encoded``; ``covered`` is the number of source bytes in spans."""
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return encoded(docs, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (total("ends") - total("starts")).alias("covered"),
    )
