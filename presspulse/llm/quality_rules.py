"""Line-first quality rules.

Every line is judged on its own; lines that fail a rule are removed, and a document that loses more than
half of the characters of its words is rejected. The rules, for lines with a word:

* symbols: more than one of ``[#*$%&|<>]`` for every two words;
* shouting: more than one ``!`` for every two words;
* punctuation: ``OPEN_WORDS`` words or more, none of ``.!?:;`` and no sentence end before trailing white space;
* navigation: three separators (words that are one of ``SEPARATORS``) or more, one in four words;
* boilerplate: a phrase of ``BOILERPLATE``, in a line of at most ``BOILERPLATE_WORDS`` words;
* repetition: equal to an earlier line of the document.

Words are runs of characters other than space and ``\\t \\n \\v \\f \\r``, lines are split at ``\\n``. Whole texts
are worked on as byte arrays; each row is independent, so nothing is shuffled.

Defined results: a null or empty text has no word and fails the base rule; repeated rows and null ids
get their own results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from presspulse.llm.tokens import BASE, U, mix, text_slices, utf8, words

LEAST_WORDS = 50
REPEAT_WINDOW = 3
LOST_SHARE = 0.5
OPEN_WORDS = 12
BOILERPLATE_WORDS = 30
SYMBOLS = "#*$%&|<>"
SENTENCE_ENDS = ".!?…:;\"'”’»)]。！？"
INNER_ENDS = ".!?:;"
SEPARATORS = ("|", "»", "›", ">", "/", "·", "•", "-", "–")
#: Phrases of page furniture and licence lines, in lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "uses cookies", "click here", "sign up for", "subscribe to", "powered by", "skip to content", "back to top",
)
COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_lines long, n_removed_lines long, left_chars long"
)
SPACES = (0x20, *range(0x09, 0x0E))


def _table(chars: str) -> np.ndarray:
    held = np.zeros(256, bool)
    held[[ord(c) for c in chars]] = True
    return held


WORD = np.ones(256, bool)
WORD[list(SPACES)] = False


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each range of consecutive offsets."""
    ends = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return ends[offsets[1:]] - ends[offsets[:-1]]


def _again(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether an equal one of its document comes before, and whether there is another."""
    order = np.lexsort((np.arange(len(doc)), hashes, doc))
    d, h = doc[order], hashes[order]
    same = np.zeros(len(d) + 1, bool)
    same[1:-1] = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    before, other = np.zeros(len(d), bool), np.zeros(len(d), bool)
    before[order] = same[:-1]
    other[order] = same[:-1] | same[1:]
    return before, other


def _flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(bool)


def judge(texts: pa.Array) -> dict[str, np.ndarray]:
    """The columns of each text, but the id."""
    docs = len(texts)
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines = split.flatten()
    of_line = np.repeat(np.arange(docs), pc.list_value_length(split).to_numpy())
    data, at = utf8(lines)
    inside = WORD[data]
    first_byte = (data & 0xC0) != 0x80
    chars = _sums(inside & first_byte, at)
    symbols = _sums(_table(SYMBOLS)[data], at)
    found = words(lines, WORD, lower=False)
    n = found.count

    whole = words(lines, np.ones(256, bool), lower=False)  # each line that is not empty is one word
    line_hash = np.zeros(len(lines), U)
    line_hash[whole.doc] = whole.hash
    dup = _again(of_line, line_hash)[0] & (n > 0)
    doc = of_line[found.doc]
    repeated = np.zeros(len(doc), bool)
    window = np.flatnonzero(doc[REPEAT_WINDOW - 1 :] == doc[: len(doc) - REPEAT_WINDOW + 1]) if len(doc) >= REPEAT_WINDOW else np.zeros(0, int)
    keys = np.zeros(len(window), U)
    for j in range(REPEAT_WINDOW):
        keys = mix(keys * U(BASE) + found.hash[window + j])
    hit = window[_again(doc[window], keys)[1]]
    for j in range(REPEAT_WINDOW):
        repeated[hit + j] = True

    trimmed = pc.utf8_rtrim(lines, "".join(map(chr, SPACES)))
    ended = _flags(pc.is_in(pc.utf8_slice_codeunits(trimmed, -1), pa.array(list(SENTENCE_ENDS))))
    furniture = np.zeros(len(lines), bool)
    small = pc.utf8_lower(lines)
    for phrase in BOILERPLATE:
        furniture |= _flags(pc.match_substring(small, phrase))
    separator_hashes = words(pa.array(SEPARATORS), WORD, lower=False).hash
    separators = np.bincount(found.doc[np.isin(found.hash, separator_hashes)], minlength=len(lines))
    failed = (
        (2 * symbols > n)
        | (2 * _sums(data == ord("!"), at) > n)
        | ((n >= OPEN_WORDS) & ~ended & (_sums(_table(INNER_ENDS)[data], at) == 0))
        | ((separators >= 3) & (4 * separators >= n))
        | (furniture & (n <= BOILERPLATE_WORDS))
        | dup
    ) & (n > 0)

    total = lambda values: np.bincount(of_line, weights=values, minlength=docs).astype(np.int64)
    n_words, word_chars, repeat = total(n), total(chars), np.bincount(doc[repeated], minlength=docs)
    left = total(np.where(failed, 0, chars))
    base_failed = (n_words < LEAST_WORDS) | (100 * repeat > 50 * n_words)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": total(symbols),
        "n_dup_lines": total(dup),
        "n_repeat_words": repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & (left >= (1 - LOST_SHARE) * word_chars),
        "n_lines": total(n > 0),
        "n_removed_lines": total(failed),
        "left_chars": left,
    }


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole):
            columns = judge(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), *map(pa.array, columns.values())], names=["doc_id", *columns])


def line_quality(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each row of ``docs(doc_id, text)``."""
    return docs.select("doc_id", "text").mapInArrow(_judge, COLUMNS)
