"""Text, HTML, identifier and coercion column functions.

Everything is a built-in expression: regex functions run on the JVM in
codegen, so there is no Python on the hot path.
"""

from __future__ import annotations

from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions._util import col as _c

# The character references of HTML: all names with their text, from the standard table that Python ships. Some old
# names also count without the semicolon, and in front of other letters.
ENTITIES = sorted((name.encode(), name, text) for name, text in html5.items())
OLD_ENTITIES = {name: text for name, text in html5.items() if not name.endswith(";")}

# Numeric references to bytes of the old Windows code page stand for its characters; those without one for themselves.
WINDOWS = {c: bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)}

# Ranges of code points that a numeric reference yields nothing for (controls and non-characters; the
# last two of every plane too).
NOTHING = ((0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x9F), (0xFDD0, 0xFDEF))

# Whitespace as Python's ``str.split()`` / ``re`` ``\s`` see it (Unicode
# White_Space plus the ASCII separators 0x1C-0x1F), in a syntax both the JVM
# regex engine and RE2 accept.
PY_WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")

# Task status text (lower case) -> status code.
STATUS_CODES = {
    "новая": "new",
    "назначен ответственный": "responsible_assigned",
    "назначена": "responsible_assigned",
    "в работе": "work",
    "отправлено на доработку": "rework",
    "на доработке": "rework",
}

# yes/no words for booleans rendered as text.
YES_TEXT, NO_TEXT = "Да", "Нет"


# --- JSON ------------------------------------------------------------------

def json_text(c, *keys: str) -> Column:
    """Text at a JSON path, ``''`` when absent.

    Applied one key at a time (nested call form), so a value that is itself a
    JSON-encoded string is read through as well.
    """
    out = _c(c)
    for k in keys:
        out = F.get_json_object(out, f"$.{k}")
    return F.coalesce(out, F.lit(""))


def json_int(c, *keys: str) -> Column:
    """Integer at a JSON path; NULL when absent or not a number."""
    out = _c(c)
    for k in keys:
        out = F.get_json_object(out, f"$.{k}")
    return out.try_cast("long")


def json_pick(raw, computed, raw_keys, computed_keys, as_int: bool = False) -> Column:
    """Read from ``computed`` when ``raw`` is the literal text ``'null'``."""
    f = json_int if as_int else json_text
    return F.when(_c(raw) == F.lit("null"), f(computed, *computed_keys)).otherwise(f(raw, *raw_keys))


# --- split / cast -----------------------------------------------------------

def split_pick_int(c, sep_regex: str = r"\.", index: int = -2) -> Column:
    """Part ``index`` of a split (negative from the end) as long, else NULL."""
    return F.try_element_at(F.split(_c(c), sep_regex), F.lit(index)).try_cast("long")


def to_str(c) -> Column:
    """Id / number as text."""
    return _c(c).cast("string")


def num_or(c, default=0, type_: str = "double") -> Column:
    """Numeric coercion, bad or NULL -> ``default``."""
    return F.coalesce(_c(c).cast("string").try_cast(type_), F.lit(default).cast(type_))


def flag_text(c) -> Column:
    """X28: '0'/'1' text from a float or text flag; NULL stays NULL."""
    return _c(c).cast("string").try_cast("double").cast("int").cast("string")


def bool_text(c, yes: str = "1", no: str = "0") -> Column:
    """Boolean -> '1'/'0' (NULL -> ``no``)."""
    return F.when(_c(c), F.lit(yes)).otherwise(F.lit(no))


# --- cleaning ---------------------------------------------------------------

def clean_text(c) -> Column:
    """Drop double quotes, CR/LF -> space, collapse whitespace, trim.

    NULL and '' are returned unchanged.
    """
    x = _c(c)
    cleaned = F.trim(F.regexp_replace(F.replace(x, F.lit('"'), F.lit("")), PY_WS, " "))
    return F.when(x.isNull() | (x == ""), x).otherwise(cleaned)


def norm_accession(c) -> Column:
    """Accession normalisation, NULL when it does not look like one.

    Remove all whitespace, Cyrillic 'А'/'а' -> Latin 'A', prefix 'A' when the
    text starts with a digit, require one letter then 5+ digits, upper-case.
    """
    s = F.translate(F.regexp_replace(_c(c), PY_WS, ""), "Аа", "AA")
    s = F.when(s.rlike(r"^[0-9]"), F.concat(F.lit("A"), s)).otherwise(s)
    return F.when(s.rlike(r"^[A-Za-z][0-9]{5,}$"), F.upper(s))


def _named(name: Column) -> Column:
    """The text of a reference by its name (without the ampersand), by the longest known beginning; NULL if none is known.

    The whole name is looked up by binary search in the sorted table; beginnings can only be old names, which are short.
    """
    # each table is one literal, cut up once when the query is planned
    names, texts = (F.split(F.lit("\0".join(e[k] for e in ENTITIES)), "\0") for k in (1, 2))
    steps = F.lit([1 << b for b in range(len(ENTITIES).bit_length() - 1, -1, -1)])
    at = F.aggregate(steps, F.lit(0), lambda i, step: F.when(
        (i + step <= len(ENTITIES)) & (F.get(names, i + step - 1) <= name), i + step).otherwise(i)) - 1
    whole = F.when(F.get(names, at) == name, F.get(texts, at))
    old = F.str_to_map(F.lit("\0".join(f"{n}\1{t}" for n, t in OLD_ENTITIES.items())), F.lit("\0"), F.lit("\1"))
    sizes = range(max(map(len, OLD_ENTITIES)), min(map(len, OLD_ENTITIES)) - 1, -1)
    begun = [F.when(F.length(name) > n, F.concat(F.try_element_at(old, F.left(name, F.lit(n))), F.substr(name, F.lit(n + 1))))
             for n in sizes]
    return F.coalesce(whole, *begun)


def _numbered(ref: Column) -> Column:
    """The character of a numeric reference ``#123`` or ``#x7b`` (a semicolon may follow)."""
    hexadecimal = ref.rlike("^#[xX]")
    digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    digits = F.when(digits == "", "0").otherwise(digits)
    code = F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("int"))
    nothing = reduce(lambda a, b: a | b, (code.between(lo, hi) for lo, hi in NOTHING))
    windows = F.split(F.lit("\0".join(WINDOWS.values())), "\0")
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
            .when(code.between(0x80, 0x9F), F.get(windows, code - 0x80))
            .when(nothing | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def unescape_html(c) -> Column:
    """Decode all character references of HTML, named and numeric, as a browser does; each is decoded once."""
    text = _c(c)
    # a reference, or a run without one, or an ampersand by itself
    tokens = F.regexp_extract_all(
        text, F.lit(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"), F.lit(0))
    name = lambda t: F.substr(t, F.lit(2))
    decoded = F.transform(tokens, lambda t: F.when(~t.startswith("&") | (t == "&"), t)
                          .when(t.startswith("&#"), _numbered(name(t))).otherwise(F.coalesce(_named(name(t)), t)))
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def strip_html(c) -> Column:
    """Tags -> space, collapse whitespace, trim; NULL -> ''."""
    no_tags = F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(no_tags, PY_WS, " "))


def tag_texts(c, tag: str = "span", sep: str = "; ") -> Column:
    """Texts of every ``<tag>`` element, unescaped, stripped, non-empty, joined.

    Matching is case-insensitive and spans line breaks, first closing tag wins.
    """
    found = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")),
                                 F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), 1)
    cleaned = F.transform(found, lambda t: strip_html(unescape_html(t)))
    return F.array_join(F.filter(cleaned, lambda t: t != ""), sep)


def storage_urls(c, url_regex: str, group: int = 0, must_contain=None) -> Column:
    """URLs matching ``url_regex`` (capture ``group``), unescaped, kept
    when they contain ``must_contain`` (a Column or text, e.g. ``/docs/{id}/``),
    first-seen order, no repeats."""
    found = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(url_regex), group)
    urls = F.transform(found, lambda u: unescape_html(u))
    if must_contain is not None:
        needle = must_contain if isinstance(must_contain, Column) else F.lit(must_contain)
        urls = F.filter(urls, lambda u: u.contains(needle))
    return F.array_distinct(urls)


def map_status(c, codes: dict | None = None) -> Column:
    """Status text -> code (case-insensitive, trimmed); unknown kept trimmed."""
    codes = codes or STATUS_CODES
    m = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    t = F.trim(_c(c))
    return F.coalesce(F.try_element_at(m, F.lower(t)), t)


def to_text(c, sep: str = "; ") -> Column:
    """X26 for a string array: non-null items joined; NULL -> ''."""
    return F.coalesce(F.array_join(F.filter(_c(c), lambda x: x.isNotNull()), sep), F.lit(""))


def yes_no(c) -> Column:
    """X26 for a boolean: Да/Нет; NULL -> ''."""
    x = _c(c)
    return F.when(x.isNull(), F.lit("")).when(x, F.lit(YES_TEXT)).otherwise(F.lit(NO_TEXT))


def scalar_text(c) -> Column:
    """X26 for a scalar: trimmed text; NULL -> ''."""
    return F.coalesce(F.trim(_c(c).cast("string")), F.lit(""))


def full_name(last, first, middle, fallback) -> Column:
    """Up to three name parts joined by a space, empties skipped;
    the fallback id text when nothing is left."""
    parts = [F.nullif(_c(p), F.lit("")) for p in (last, first, middle)]
    name = F.nullif(F.trim(F.concat_ws(" ", *parts)), F.lit(""))
    return F.coalesce(name, _c(fallback).cast("string"))


def json_struct(c, fields) -> Column:
    """Parse a JSON object once into a struct of text fields (``from_json``).

    A field that holds an object or a number comes back as its JSON text, so
    nested objects can be parsed again with another ``json_struct`` call (the
    nested-call read of X17, which also accepts a doubly encoded object).
    Malformed text or the literal ``null`` gives NULL fields.
    """
    schema = ", ".join(f"`{f}` string" for f in fields)
    return F.from_json(_c(c), schema)
