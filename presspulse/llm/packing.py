"""Packing of tokenised documents into training sequences by the sum-of-squares rule.

A document is its token ids and an end id. Full sequences of a long document stand alone; what is left
goes, whole, where it makes the sum over all fill levels of the squared number of open windows at that
level least: into an open window with room, or into a new one. The numbers are kept in an array by
level; a window that becomes full is closed.

Each task packs the documents of its partition, in order, so there is no shuffle, and a repeated task
gives the same sequences. Only open windows are held, as ids of two bytes where the vocabulary allows it, so a task
holds less than its split has text. At the end they are emptied: their pieces are laid end to end and cut
into full sequences, and what remains, less than one sequence in each partition, into sequences whose
lengths are powers of two, which need no padding.

Defined results: null and empty texts are the end id alone; repeated rows are packed each; rows with a
null id keep it; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

SEQUENCE = 2048
END = 1
#: The vocabulary of byte_bpe_50k.json as ranks; both give the same ids.
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ROWS_AT_ONCE = 4096


def encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file; tasks of one worker process share it."""
    known = tiktoken.registry.ENCODINGS  # by way of the module, which is not shipped with the task
    if path not in known:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        known[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return known[path]


class Packer:
    """Windows of one partition. Finished pieces are rows in ``done``."""

    def __init__(self, base: int, size: int = SEQUENCE):
        self.size, self.next_id, self.done = size, base, []
        self.count = np.zeros(size + 1, np.int64)  # open windows by fill level
        self.open: dict[int, list[list]] = {}

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) // self.size * self.size
        for at in range(0, whole, self.size):
            self._close([(doc_id, at, ids[at : at + self.size], len(ids))])
        if whole < len(ids):
            rest = ids[whole:]
            self._place((doc_id, whole, rest.astype(np.uint16 if rest.max() < 1 << 16 else np.uint32), len(ids)))

    def _place(self, piece: tuple) -> None:
        n = len(piece[2])
        cost = 2 * self.count[n:] + 1  # by the level before: the level it leads to gains a window
        cost[-1] = 0  # a full window is closed
        cost[1:] -= np.where(self.count[1 : len(cost)] > 0, 2 * self.count[1 : len(cost)] - 1, np.iinfo(np.int32).min)
        level = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = [piece]
        if level:
            self.count[level] -= 1
            window = self.open[level].pop()
            window.append(piece)
        if level + n == self.size:
            self._close(window)
        else:
            self.count[level + n] += 1
            self.open.setdefault(level + n, []).append(window)

    def _close(self, window: list) -> None:
        offset = 0
        for doc_id, start, ids, tokens in window:
            self.done.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), tokens, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def empty(self) -> None:
        """Cut the pieces of all open windows into full sequences, and the rest into powers of two."""
        pieces = deque(p for level in sorted(self.open) for window in self.open[level] for p in window)
        left = sum(len(p[2]) for p in pieces)
        self.count[:] = 0
        self.open = {}
        rest = left % self.size
        lengths = [self.size] * (left // self.size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        for length in lengths:
            window, room = [], length
            while room:
                doc_id, start, ids, tokens = pieces.popleft()
                window.append((doc_id, start, ids[:room], tokens))
                if len(ids) > room:
                    pieces.appendleft((doc_id, start + room, ids[room:], tokens))
                room -= len(window[-1][2])
            self._close(window)

    def rows(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECES.split(", ")]
        columns = zip(*self.done, strict=True) if self.done else [()] * len(names)
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _pack(vocabulary: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(vocabulary)
        packer = Packer(TaskContext.get().partitionId() << 40, size)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = tokens.encode_to_numpy(text.as_py() or "", allowed_special="all")
                packer.add(doc_id, np.append(ids, np.uint32(END)))
                if len(packer.done) >= ROWS_AT_ONCE:
                    yield packer.rows()
        packer.empty()
        yield packer.rows()

    return pack


def packed_pieces(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """A row for each piece: its document, place and length there, checksum of its ids, and its place in
    a sequence. ``vocabulary`` is the path of a rank file on the executors; ``size`` a power of two."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(_pack(path, size), PIECES)
