"""Words and word shingles of whole text batches as NumPy arrays of 64-bit hashes.

A word is a longest run of ASCII letters, ASCII digits and non-ASCII characters of the lower-cased
text. A shingle is ``k`` consecutive words; a text with fewer words, but at least one, has one shingle
of all its words. Null and empty texts have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SLICE_BYTES = 1 << 20

U = np.uint64
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[128:] = True
for low, high in ((48, 58), (65, 91), (97, 123)):
    WORD_BYTE[low:high] = True
BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


class Words(NamedTuple):
    doc: np.ndarray  # index of the text of each word, ascending
    hash: np.ndarray
    count: np.ndarray  # words of each text


class Shingles(NamedTuple):
    doc: np.ndarray
    hash: np.ndarray
    count: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes; overwrites nothing."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes; a longer text has a range of its own."""
    ends = np.cumsum(lengths)
    begin = 0
    while begin < len(lengths):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield begin, end
        begin = end


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    for begin, end in slices(lengths, limit):
        yield batch.slice(begin, end - begin)


def row_slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """All batches in parts of at most ``rows`` rows."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, offsets - offsets[0]


def _powers(base: int, n: int) -> np.ndarray:
    held = np.full(n + 1, base, U)
    held[0] = 1
    return np.multiply.accumulate(held)


def words(texts: pa.Array, word_byte: np.ndarray = WORD_BYTE, lower: bool = True) -> Words:
    """Hashes of the words of every text, in order."""
    data, offsets = utf8(pc.utf8_lower(texts) if lower else texts)
    inside = word_byte[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * _powers(BASE, len(data))[:-1], out=sums[1:])
    moved = _powers(BASE_INVERSE, len(data))[starts]  # makes the sum independent of the place
    hashes = mix((sums[ends] - sums[starts]) * moved + (ends - starts).astype(U) * U(BASE))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return Words(doc, hashes, np.bincount(doc, minlength=len(texts)))


def shingles(found: Words, k: int = SHINGLE_WORDS) -> Shingles:
    """Shingles of every text, in order, repeated ones included."""
    n, docs = len(found.hash), len(found.count)
    first = np.cumsum(found.count) - found.count
    place = np.arange(n) - first[found.doc]
    weight = np.array([pow(BASE, j + 1, 1 << 64) for j in range(k)], U)
    short = (found.count > 0) & (found.count < k)
    lone = np.zeros(docs, U)
    at = np.flatnonzero(short[found.doc])
    np.add.at(lone, found.doc[at], found.hash[at] * weight[place[at]])
    at = np.flatnonzero(place + k <= found.count[found.doc])
    total = np.zeros(len(at), U)
    for j in range(k):
        total += found.hash[at + j] * weight[j]
    doc = np.concatenate([found.doc[at], np.flatnonzero(short)])
    total = mix(np.concatenate([total, lone[short] + found.count[short].astype(U)]))
    if short.any():
        order = np.argsort(doc, kind="stable")
        doc, total = doc[order], total[order]
    return Shingles(doc, total, np.bincount(doc, minlength=docs))


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two bags of shingles: common occurrences over all; 0 for empty bags."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(nx[i], ny[j]).sum())
    return common / (len(a) + len(b) - common) if common else 0.0
