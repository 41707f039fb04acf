"""Company mentions: all names and aliases in one automaton, every text read once.

A name occurs where its letters stand in the text, case apart, on word boundaries. An automaton over all
names finds the occurrences in one pass over a text, however many names there are; only the two
characters next to an occurrence are looked at after that. The automaton is shipped once to each
worker. A dimension of more names than ``NAMES_AT_ONCE`` is dealt by ticker into parts of about that
size, and the texts are read once for each part, so that what is shipped stays bounded.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES_AT_ONCE = 500_000
END_OF_CASE = 0x1F000  # no letter from here on has two cases


def candidate_names(name: Column, aliases: Column) -> Column:
    names = F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (n != "")))


def folded_letters() -> dict[int, str]:
    """Letters whose case-folded form differs from them. A form is one letter, so that places stay the same:
    the upper case of a letter, or its title case where that is the single one, in lower case."""
    table = {}
    for code in range(END_OF_CASE):
        c = chr(code)
        upper = next((u for u in (c.upper(), c.title()) if len(u) == 1), c)
        folded = "i" if upper == "İ" else upper.lower()
        if len(folded) == 1 and folded != c:
            table[code] = folded
    return table


def is_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


class NameMatcher:
    """Tickers of the names that occur in a text."""

    def __init__(self, names: Iterable[tuple[str, str]]):
        self.letters = folded_letters()
        self.odd = re.compile("[" + "".join(chr(c) for c, folded in self.letters.items() if folded != chr(c).lower()) + "]")
        self.automaton = ahocorasick.Automaton()
        tickers: dict[str, list[str]] = {}
        for ticker, name in names:
            if name.strip(" "):
                tickers.setdefault(self.fold(name.strip(" ")), []).append(ticker)
        for name, owners in tickers.items():
            self.automaton.add_word(name, (len(name), is_word(name[0]), is_word(name[-1]), tuple(dict.fromkeys(owners))))
        if tickers:
            self.automaton.make_automaton()

    def fold(self, text: str) -> str:
        """The text in folded letters. Lower case is that already, but for few letters."""
        low = text.lower()
        return low if len(low) == len(text) and not self.odd.search(low) else text.translate(self.letters)

    def tickers(self, text: str) -> list[str]:
        """In the order in which their names first end in the text."""
        if not len(self.automaton):
            return []
        found: dict[str, None] = {}
        for end, (size, opens, closes, owners) in self.automaton.iter(self.fold(text)):
            begin = end + 1 - size
            # a boundary is where exactly one of two neighbours belongs to a word
            before = begin > 0 and is_word(text[begin - 1])
            after = end + 1 < len(text) and is_word(text[end + 1])
            if before != opens and after != closes:
                found.update(dict.fromkeys(owners))
        return [*found]


def _matched(matcher, keys: Sequence[str], own: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = matcher.value
        for batch in batches:
            rows, found = [], []
            owners = batch["__own"] if own else [None] * batch.num_rows
            for i, (text, mine) in enumerate(zip(batch["__text"], owners, strict=True)):
                hits = names.tickers(text.as_py())
                if own:
                    hits = [t for t in hits if t == mine.as_py()]
                rows += [i] * len(hits)
                found += hits
            at = pa.array(rows, pa.int64())
            columns = {k: batch[k].take(at) for k in keys}
            yield pa.RecordBatch.from_pydict(columns if own else columns | {"ticker": pa.array(found, pa.string())})

    return match


def match_companies(articles: DataFrame, companies: DataFrame, keys: str | Sequence[str], text: str | Column, own: str | None = None) -> DataFrame:
    """The ``keys`` of each row of ``articles`` with every ``ticker`` whose company's name or alias its text
    mentions. With ``own``, a column of ``articles``: the ``keys`` of the rows that mention that ticker's company."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    spark = articles.sparkSession
    column = F.col(text) if isinstance(text, str) else text
    extra = [F.col(own).alias("__own")] if own else []
    read = articles.select(*keys, *extra, column.alias("__text")).where(F.col("__text") != "")
    schema = T.StructType(read.select(*keys).schema.fields)
    schema = schema if own else schema.add("ticker", "string")
    names = companies.where("ticker is not null").select("ticker", F.explode(candidate_names(F.col("name"), F.col("aliases"))).alias("name"))
    parts = max(1, math.ceil(names.count() / NAMES_AT_ONCE))
    out = None
    for part in range(parts):
        some = names.where(F.pmod(F.xxhash64("ticker"), F.lit(parts)) == part).sort("ticker", "name").collect()
        matcher = spark.sparkContext.broadcast(NameMatcher(map(tuple, some)))
        hits = read.mapInArrow(_matched(matcher, keys, own), schema)
        out = hits if out is None else out.unionAll(hits)
    return out
