"""Main text of web pages: template deduction by equivalence classes of tokens, then slot extraction.

1. Each page is cut into tokens: tags with the path of their open elements, and text blocks with their path.
   A token's occurrence vector holds how often it occurs on each page of its host. Tokens of a host with the
   same vector form an equivalence class. Vectors are compared by additive fingerprints (the sum over pages of
   page hash times count) with the page count and total, so that a host of any size is pre-aggregated where its
   pages are read and never gathered. Copies (equal html on one host) are one page here: repetition of a whole
   page says nothing about its parts.
2. A class is valid if it is on at least ``LEAST_PAGES`` pages and ``LEAST_SHARE`` of the host's, and if it has
   several members, one of them text: then its text is part of the template. The paths in the tokens say how
   valid classes nest. A page that would lose all its text to the template keeps it.
3. A page's slots are the stretches between template tokens. Extraction drops template text, and slots inside
   elements that carry no article text (menus, footers, forms, adverts and so on, by element name, by a
   ``hidden`` attribute, or by a class, id or role all of whose parts say so), and joins the blocks of the
   remaining slots. The words of ``html``, ``body``, ``main`` and ``article`` elements say nothing about the
   page and never drop it. If an ``article`` or ``main`` element that is not dropped has text, only slots inside
   such elements count.

Hosts with few pages have no valid class; for them the third step stands alone.

Text inside a block is decoded and its white space collapsed; blocks are joined by one space. The whole text
of every page is used.

Defined results: a null or empty html gives an empty text; a null url is a host of its own; repeated rows get
their own results; broken markup is read on as far as it goes (an end tag closes what was opened inside it and
is ignored if nothing is open; a script without an end runs to the end of the page).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presspulse.llm.url_filter import host_and_path
from presspulse.sources.storage import MAX_BROADCAST_ROWS, cut_lineage

LEAST_PAGES, LEAST_SHARE = 8, 0.6
#: Elements without article text, elements that end a block, elements without content, and raw text elements.
DROPPED = frozenset("nav footer aside form script style noscript template iframe object svg math canvas button select textarea input head title menu dialog audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|iframe|xmp"
#: Words of class, id and role that mark parts beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments contentinfo cookie cookies disclaimer discuss disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices outbrain pagination pager popup promo related reply replies search share sharing sidebar signup social sponsor sponsored subscribe taboola toolbar widget".split()
)
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?P<rawattrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>(?P<inside>.*?)(?:</(?P=raw)\s*[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
#: Elements that hold the page or the article, whatever their classes.
HOLDERS = frozenset("html body main article".split())


class Block:
    """Text between two block borders with the path it stands in."""

    __slots__ = ("path", "parts", "dropped", "main")

    def __init__(self, path: str, dropped: bool, main: bool):
        self.path, self.parts, self.dropped, self.main = path, [], dropped, main

    def text(self) -> str:
        joined = "".join(self.parts)
        return " ".join((html.unescape(joined) if "&" in joined else joined).split())


def _marks_beside(token: str) -> bool:
    """Whether a class, id or role is a word of ``BESIDE`` or made of nothing else (``cookie-notice``)."""
    parts = [p for p in SPLIT.split(token) if p]
    return bool(parts) and BESIDE.issuperset(parts)


def _beside(name: str, attrs: str, inside_main: bool) -> bool:
    if name in DROPPED or (name == "header" and not inside_main):
        return True
    if name in ("html", "body"):
        return False
    if "hidden" in attrs.lower() and any(m[1].lower() == "hidden" for m in ATTRIBUTE.finditer(attrs)):
        return True
    if "=" not in attrs or name in HOLDERS:
        return False
    return any(_marks_beside(t) for m in NAMED.finditer(attrs) for t in (m[1] or m[2] or m[3] or "").lower().split())


def read(page: str) -> tuple[list[Block], list[str]]:
    """Blocks of a page in order, and its start tags with their paths."""
    stack: list[tuple[str, bool, bool, str]] = [("", False, False, "")]  # name, dropped, main, path
    blocks, tags = [Block("", False, False)], []

    def border() -> None:
        _, dropped, main, path = stack[-1]
        blocks.append(Block(path, dropped, main))

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            blocks[-1].parts.append(page[at : m.start()])
        at = m.end()
        if m["raw"]:
            tags.append(f"{stack[-1][3]}/{m['raw'].lower()}")
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    closed = stack[i:]
                    del stack[i:]
                    if any(c[0] in BLOCKS or c[1] != stack[-1][1] or c[2] != stack[-1][2] for c in closed):
                        border()
                    break
            continue
        _, dropped, main, path = stack[-1]
        attrs = m["attrs"]
        marks = " ".join(sorted(x[1] or x[2] or x[3] or "" for x in NAMED.finditer(attrs))) if "=" in attrs else ""
        inner = f"{path}/{name}" if not marks else f"{path}/{name}.{marks}"
        if name == "p" and stack[-1][0] == "p":  # a paragraph ends where the next begins
            stack.pop()
            _, dropped, main, path = stack[-1]
            inner = f"{path}/p" if not marks else f"{path}/p.{marks}"
        tags.append(inner)
        if name in VOID or attrs.endswith("/"):
            if name in BLOCKS:
                border()
            continue
        hidden = dropped or _beside(name, attrs, main)
        stack.append((name, hidden, main or name in ("article", "main"), inner))
        if name in BLOCKS or hidden != dropped:
            border()
    if at < len(page):
        rest = page[at:]
        blocks[-1].parts.append(rest if not rest.startswith("<") else "")
    return blocks, tags


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)


def page_tokens(page: str) -> Counter:
    """How often each token occurs on a page. Text tokens are odd."""
    blocks, tags = read(page)
    return Counter([*(_hash(t) & ~1 for t in tags), *(_hash(b.path, x) | 1 for b in blocks if (x := b.text()))])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of the tokens of the pages at hand, added up by host."""
    for batch in batches:
        rows: dict[tuple, list[int]] = {}
        for host, page in zip(batch["host"].to_pylist(), batch["html"], strict=True):
            page = page.as_py() or ""
            key = _hash(page)
            for token, n in page_tokens(page).items():
                held = rows.setdefault((host, token), [0, 0, 0])
                held[0] += 1
                held[1] += n
                held[2] = (held[2] + key * n) & 0xFFFFFFFF  # the sum of any number of these fits a long
        columns = zip(*((h, t, *v) for (h, t), v in rows.items()), strict=True) if rows else [()] * 5
        kinds = [pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "token", "pages", "total", "vector"])


def _contents(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each different page of ``pages(host, html)`` once, and the number of them of each host.

    Only copies are shuffled, collapsed where they are read, as long as the keys of copied pages can be broadcast.
    """
    rows = pages.where("host is not null").select("host", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"content": F.xxhash64("html"), "chars": F.length("html")})
    key = ["host", "content", "chars"]
    keys = cut_lineage(rows.groupBy(*key).agg(F.count("*").alias("n")))
    sizes = keys.groupBy("host").agg(F.count("*").alias("host_pages"))
    copied = keys.where("n > 1").select(*key)
    collapsed = lambda some: some.groupBy(*key).agg(F.first("html").alias("html")).select("host", "html")
    if copied.limit(MAX_BROADCAST_ROWS + 1).count() > MAX_BROADCAST_ROWS:
        return collapsed(rows), sizes
    copied = F.broadcast(copied)
    return rows.join(copied, key, "left_anti").select("host", "html").unionByName(collapsed(rows.join(copied, key, "left_semi"))), sizes


def templates(pages: DataFrame) -> DataFrame:
    """``(host, token)``: the text tokens of the valid classes of each host of ``pages(host, html)``."""
    contents, sizes = _contents(pages)
    seen = contents.mapInArrow(_tokens, "host string, token long, pages long, total long, vector long")
    vectors = seen.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.pmod(F.sum("vector"), F.lit(1 << 32)).alias("vector"))
    often = vectors.where(F.col("pages") >= LEAST_PAGES).join(sizes, "host").where(F.col("pages") >= LEAST_SHARE * F.col("host_pages"))
    held = cut_lineage(often.select("host", "token", "pages", "total", "vector"))
    classes = held.groupBy("host", "pages", "total", "vector").agg(
        F.sum(F.when(F.col("token").bitwiseAND(1) == 1, 1).otherwise(0)).alias("texts"), F.count("*").alias("members")
    )
    valid = classes.where("texts > 0 and members > 1").drop("texts", "members")
    return held.join(valid, ["host", "pages", "total", "vector"]).where(F.col("token").bitwiseAND(1) == 1).select("host", "token")


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """The article text of a page, without the text tokens of ``template``."""
    if not page:
        return ""
    blocks, _ = read(page)
    held = [(b, text) for b in blocks if b.parts and not b.dropped and (text := b.text())]
    out = [(b, text) for b, text in held if _hash(b.path, text) | 1 not in template] if template else held
    out = out or held
    inside = any(b.main for b, _ in out)
    return " ".join(text for b, text in out if b.main or not inside)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[str, frozenset[int]] = {}
        texts = []
        for host, page, template in zip(batch["host"].to_pylist(), batch["html"], batch["template"], strict=True):
            if host not in held:
                held[host] = frozenset(template.as_py() or ())
            texts.append(main_text(page.as_py(), held[host]))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extracted_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages(page_id, url, html)``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", host_and_path(F.col("url"))["host"].alias("host"))
    found = cut_lineage(templates(rows.select("host", "html")))
    by_host = found.groupBy("host").agg(F.collect_list("token").alias("template"))  # at most the tokens of a page / LEAST_SHARE
    if found.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        by_host = F.broadcast(by_host)
    whole = rows.join(by_host, "host", "left").mapInArrow(_extract, "page_id long, url string, text string")
    return whole.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
