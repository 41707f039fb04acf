"""Text, URL and date-string expressions. All are plain Columns: no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from presspulse import config as C

# Character classes spelled out, so that the meaning of "word" and "space" does not
# depend on regex flags: letters, numbers and underscore; all Unicode separators.
# runs of anything else, with the common characters first since a class is tested in order
NON_WORDS = r"[^a-z0-9_\p{L}\p{N}]+"
SPACE = r"\t-\r\x{1c}-\x{1f}\x{85}\p{Z}"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``use`` (which may mention it many times)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normalize_headline(c: Column) -> Column:
    """Lower case, every run of non-word characters becomes one space, NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), NON_WORDS, " ")), F.lit(""))


def clean_text(c: Column) -> Column:
    """Collapse whitespace runs and trim; NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, f"[{SPACE}]+", " ")), F.lit(""))


def token_set(c: Column) -> Column:
    """Distinct words of the normalised text (an empty text has none)."""
    words = F.split(F.lower(F.coalesce(c, F.lit(""))), NON_WORDS)
    return F.array_remove(F.array_distinct(words), "")


def scoring_text(headline: Column, summary: Column) -> Column:
    """``headline. summary`` without surrounding dots and blanks."""
    joined = F.concat(F.coalesce(headline, F.lit("")), F.lit(". "), F.coalesce(summary, F.lit("")))
    stripped = F.regexp_replace(joined, r"^[. ]+|[. ]+$", "")
    return F.regexp_replace(stripped, f"^[{SPACE}]+|[{SPACE}]+$", "")


def stable_hash(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)


# --- URLs ------------------------------------------------------------------------

_URL_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def canonical_url(c: Column) -> Column:
    """URL as a duplicate key: no scheme, fragment, ``www.``, tracking parameters or trailing slash."""
    url = F.trim(c)
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _URL_PARTS, 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, _URL_PARTS, 2), r"/+$", "")

    def keep(pair: Column) -> Column:
        name = F.lower(F.substring_index(pair, "=", 1))
        tracked = F.lit(False)
        for prefix in C.TRACKING_PARAM_PREFIXES:
            tracked = tracked | F.startswith(name, F.lit(prefix))
        return (pair != "") & ~tracked

    pairs = F.filter(F.split(F.regexp_extract(url, _URL_PARTS, 3), "&"), keep)
    query = bind(pairs, lambda p: F.when(F.size(p) > 0, F.concat(F.lit("?"), F.array_join(p, "&"))).otherwise(""))
    return F.coalesce(F.regexp_replace(F.concat(host, path, query), "^/+", ""), F.lit(""))


_WEB_URL = r"^(?i:https?)://([^/?#]+)"


def is_valid_url(c: Column) -> Column:
    return F.coalesce(c.rlike(_WEB_URL), F.lit(False))


def publisher_from_url(c: Column) -> Column:
    """Known publisher of the host (exact or sub-domain, first listed wins), else the bare host, else ''."""

    def known(host: Column) -> Column:
        names = [
            F.when((host == domain) | F.endswith(host, F.lit("." + domain)), F.lit(name))
            for domain, name in C.PUBLISHER_DOMAINS
        ]
        return F.coalesce(*names, host, F.lit(""))

    return bind(F.regexp_replace(F.lower(F.regexp_extract(c, _WEB_URL, 1)), r"^www\.", ""), known)


# --- page bodies -----------------------------------------------------------------

_HIDDEN = "|".join(rf"<{tag}\b[^>]*>.*?</{tag}\s*>" for tag in ("script", "style", "head", "nav"))
HIDDEN_BLOCKS = rf"(?is)<!--.*?-->|{_HIDDEN}"
# fixed values: character references by name
REFERENCES = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "amp": "&"}
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-z]{2,6});"


def decode_references(c: Column) -> Column:
    """Character references by number and by the names above, each decoded once. Other names stay as they are;
    numbers that are no character become U+FFFD."""
    names = F.create_map(*[F.lit(x) for kv in REFERENCES.items() for x in kv])

    def char(ref: Column) -> Column:
        hexed = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.substring(ref, 3, 6))
        number = F.coalesce(F.conv(hexed, 16, 10), F.substring(ref, 2, 7)).try_cast("int")
        known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        code = F.when(known, number).otherwise(0xFFFD)
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        named = F.coalesce(F.try_element_at(names, ref), F.concat(F.lit("&"), ref, F.lit(";")))
        return F.when(ref.startswith("#"), F.when(number == 160, " ").otherwise(plain)).otherwise(named)

    found = F.transform(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(1)), char)
    between = F.split(c, _REFERENCE, -1)
    whole = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda t, x: F.concat(t, x))
    return F.when(F.contains(c, F.lit("&")), F.array_join(whole, "")).otherwise(c)


def page_text(html: Column) -> Column:
    """Readable text of a page: hidden blocks and tags dropped, character references decoded."""
    t = F.regexp_replace(html, HIDDEN_BLOCKS, " ")
    return clean_text(decode_references(F.regexp_replace(t, "<[^>]*>", " ")))


def page_title(html: Column) -> Column:
    return clean_text(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1))


# --- publication dates -------------------------------------------------------------

_RFC_DATE = (
    r"(?i)^\s*(?:[a-z]{3},\s*)?(\d{1,2})\s+([a-z]{3})\s+(\d{4})\s+"
    r"(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+(?:([+-])(\d{2})(\d{2})|([a-z]{1,4})))?\s*$"
)
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# fixed values: zone names of the mail date format, minutes east of UTC
_ZONES = {
    "ut": 0, "utc": 0, "gmt": 0, "z": 0, "est": -300, "edt": -240, "cst": -360,
    "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}


def parse_published_at(c: Column, naive_offset_minutes: int = 0) -> Column:
    """Mail-format date to IST wall clock (timestamp_ntz); anything unparsable becomes NULL.

    Dates without a zone are read at ``naive_offset_minutes`` east of UTC.
    """
    part = lambda i: F.regexp_extract(c, _RFC_DATE, i)
    number = lambda i: F.expr("int(0)") if i is None else part(i).try_cast("int")
    month = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.lower(part(2))).cast("int")
    local = F.try_make_timestamp_ntz(
        number(3), F.when(month > 0, month), number(1), number(4), number(5),
        F.coalesce(number(6), F.lit(0)).cast("decimal(16,6)"),
    )
    sign = F.when(part(7) == "-", -1).otherwise(1)
    named = F.coalesce(
        *[F.when(F.lower(part(10)) == z, F.lit(m)) for z, m in _ZONES.items()], F.lit(naive_offset_minutes)
    )
    offset = F.when(part(7) != "", sign * (number(8) * 60 + number(9))).otherwise(named)
    return local + F.make_dt_interval(mins=F.lit(C.IST_OFFSET_MINUTES) - offset)
