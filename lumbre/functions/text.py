"""Text functions as column expressions, evaluated in the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the white space that collapsing covers, no-break space included.
SPACES = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]+"
#: Printed forms of case numbers and time stamps.
PROCESS_NUMBER = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"
TIMESTAMP = r"(?s)^(\d{2}/\d{2}/\d{4}(?:\s+\d{2}:\d{2}:\d{2})?)\s*[-–]\s*(.*)$"


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapse_spaces(c: Column) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


@cache
def _unaccented() -> tuple[str, str]:
    """Letters with a canonical decomposition into a base letter and marks, and their bases."""
    pairs = []
    for block in (range(0xC0, 0x250), range(0x370, 0x530), range(0x1E00, 0x2000)):
        for ch in map(chr, block):
            full = unicodedata.normalize("NFD", ch)
            bare = "".join(x for x in full if not 0x300 <= ord(x) <= 0x36F)
            if full != ch and len(bare) == 1 and bare != ch:
                pairs.append((ch, bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def deaccent(c: Column) -> Column:
    """Letters without their diacritics (Latin, Greek and Cyrillic), as columns.

    Decomposed input loses its combining marks as well.
    """
    accented, bare = _unaccented()
    return F.regexp_replace(F.translate(c, accented, bare), r"[\u0300-\u036F]", "")


def process_number(c: Column) -> Column:
    return _blank_to_null(F.regexp_extract(c, PROCESS_NUMBER, 0))


def leading_timestamp(c: Column) -> tuple[Column, Column]:
    """(date and time, the rest) of ``dd/MM/yyyy[ HH:mm:ss] - rest``; (null, the whole) otherwise."""
    stamped = c.rlike(TIMESTAMP)
    return F.when(stamped, F.regexp_extract(c, TIMESTAMP, 1)), F.when(stamped, F.regexp_extract(c, TIMESTAMP, 2)).otherwise(c)


def trailing_parentheses(c: Column) -> Column:
    return _blank_to_null(F.regexp_extract(c, r"\(([^()]+)\)\s*$", 1))


def taxpayer_id(c: Column) -> Column:
    return _blank_to_null(F.regexp_extract(c, r"(?i)\b(CPF|CNPJ)\s*:\s*([\d./-]+)", 2))


def size_text(c: Column) -> Column:
    return _blank_to_null(F.regexp_extract(c, r"(?i)\(([\d.,]+\s*[KMG]?b)\)\s*$", 1))


def size_bytes(c: Column) -> Column:
    """Bytes of a size text such as ``4,62 Kb`` (decimal comma); null where it is none."""
    number = F.regexp_extract(c, r"^([\d.,]+)", 1)
    unit = F.lower(F.regexp_extract(c, r"(?i)([KMG]?)b$", 1))
    scale = F.when(unit == "k", 1024.0).when(unit == "m", 1024.0**2).when(unit == "g", 1024.0**3).otherwise(1.0)
    plain = F.replace(F.replace(number, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.round(plain.try_cast("double") * scale).cast("long")


def percent_decode(c: Column) -> Column:
    """Bytes of a percent-encoded text; broken escapes stay as they are, ``+`` is a space."""
    tokens = F.regexp_extract_all(F.replace(c, F.lit("+"), F.lit(" ")), F.lit(r"(?s)(%[0-9A-Fa-f]{2}|.)"), 1)
    pieces = F.transform(tokens, lambda x: F.when(x.rlike("^%[0-9A-Fa-f]{2}$"), F.substr(x, F.lit(2))).otherwise(F.hex(F.encode(x, "UTF-8"))))
    return F.unhex(F.array_join(pieces, ""))


def utf8_or_latin1(b: Column) -> Column:
    """Bytes as text: UTF-8 where they are valid UTF-8, else ISO-8859-1."""
    text = b.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(b, "ISO-8859-1"))


def query_param(url: Column, name: str) -> Column:
    """The first value of a query parameter, decoded; null where the url has none."""
    query = F.regexp_replace(F.regexp_extract(url, r"(?s)\?(.*)$", 1), r"(?s)#.*$", "")
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & (safe_decode(F.substring_index(p, "=", 1)) == name))
    first = F.get(pairs, F.lit(0))
    value = F.when(F.contains(first, F.lit("=")), F.regexp_replace(first, r"(?s)^[^=]*=", "")).otherwise(F.lit(""))
    return F.when(first.isNotNull(), utf8_or_latin1(percent_decode(value)))


def safe_decode(c: Column) -> Column:
    """Percent-decoded where that gives valid text, else as it is; ``+`` stays."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def slugify(c: Column) -> Column:
    """ASCII letters and digits joined by hyphens, at most 80; ``documento`` for nothing."""
    dashed = F.regexp_replace(F.regexp_replace(deaccent(c), "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(_blank_to_null(F.lower(F.substring(dashed, 1, 80))), F.lit("documento"))


def document_slug(name: Column, kind: Column, label: Column) -> Column:
    """The slug of the first that is not null; a blank one counts."""
    return slugify(F.coalesce(name, kind, label))


def popup_url(handler: Column) -> Column:
    """The url in a pop-up handler ``openPopUp('..', 'url')``; null for about:blank."""
    url = F.regexp_extract(handler, r"openPopUp\(\s*'[^']*'\s*,\s*'([^']+)'\s*\)", 1)
    return F.when((url != "") & (url != "about:blank"), F.replace(url, F.lit("&amp;"), F.lit("&")))


def detail_path(handler: Column, href: Column) -> Column:
    """The pop-up's url, else a link that carries a case key."""
    url = _blank_to_null(F.regexp_extract(handler, r"openPopUp\(\s*'[^']*'\s*,\s*'([^']+)'\s*\)", 1))
    return F.coalesce(url, F.when(F.contains(href, F.lit("ca=")), href))


def case_key(path: Column) -> Column:
    return _blank_to_null(F.regexp_extract(path, r"[?&]ca=([^&\"']+)", 1))


def internal_id(cell_id: Column) -> Column:
    return F.regexp_extract(cell_id, r"processosTable:([^:]+):", 1)


def first_non_empty(values: Column) -> Column:
    """The first value of an array that is not blank, trimmed."""
    trimmed = F.transform(values, lambda x: F.regexp_replace(x, f"^{SPACES}|{SPACES}$", ""))
    return F.get(F.filter(trimmed, lambda x: x != ""), F.lit(0))


def pick(fields: Column, *labels: str) -> Column:
    """The first label that a map has; a blank value counts."""
    return F.coalesce(*[F.element_at(fields, F.lit(label)) for label in labels])


def pick_starting(fields: Column, label: str) -> Column:
    """A map's value for a label, else for the first label that starts with it."""
    near = F.map_values(F.map_filter(fields, lambda k, _: F.startswith(k, F.lit(label))))
    return F.coalesce(F.element_at(fields, F.lit(label)), F.get(near, F.lit(0)))


def sequence_text(index: Column) -> Column:
    """``index`` + 1 in at least four digits."""
    n = (index + 1).cast("string")
    return F.lpad(n, F.greatest(F.length(n), F.lit(4)), F.lit("0"))


#: Single-byte charsets by the labels that headers use; the first is Python's name.
SINGLE_BYTE = tuple(
    [(f"iso8859-{i}", f"iso-8859-{i}", f"iso_8859-{i}", f"latin{n}") for i, n in ((2, 2), (3, 3), (4, 4), (9, 5), (10, 6), (13, 7), (14, 8), (15, 9), (16, 10))]
    + [(f"iso8859-{i}", f"iso-8859-{i}", f"iso_8859-{i}") for i in (5, 6, 7, 8)]
    + [(f"cp125{i}", f"windows-125{i}", f"x-cp125{i}") for i in range(9)]
    + [("koi8-r", "koi8r"), ("koi8-u", "koi8u"), ("mac-roman", "macintosh", "x-mac-roman"), ("cp437", "ibm437"), ("cp850", "ibm850")]
)
_UTF = {"UTF-16": ("utf-16", "utf16"), "UTF-16LE": ("utf-16le",), "UTF-16BE": ("utf-16be",), "UTF-32": ("utf-32", "utf32"), "US-ASCII": ("us-ascii", "ascii")}


@cache
def _high_half(codec: str) -> tuple[str, str]:
    """The upper 128 characters of ISO-8859-1, and what a charset has there."""
    pairs = [(chr(i), bytes([i]).decode(codec, "replace")) for i in range(128, 256)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def decode_body(body: Column, content_type: Column) -> Column:
    """Text of a body by the charset its header names; UTF-8 where none or an unknown one is.

    All in the JVM: single-byte charsets are ISO-8859-1 with their upper half exchanged.
    Multi-byte charsets other than the Unicode ones count as unknown.
    """
    charset = F.lower(F.regexp_extract(content_type, r"(?i)charset\s*=\s*[\"']?([^\s;\"']+)", 1))
    latin = F.decode(body, "ISO-8859-1")
    out = F.when(charset.isin("iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "l1"), latin)
    for codec, *labels in SINGLE_BYTE:
        out = out.when(charset.isin(codec, *labels), F.translate(latin, *_high_half(codec)))
    for name, labels in _UTF.items():
        here = charset.isin(*labels)
        out = out.when(here, F.decode(F.when(here, body), name))
    return out.otherwise(F.make_valid_utf8(body.cast("string")))


def repair_latin1(c: Column) -> Column:
    """UTF-8 that was read as ISO-8859-1 is read again, where that gives valid text."""
    narrow = ~c.rlike(r"[^\u0000-\u00FF]")
    raw = F.when(narrow, F.encode(F.when(narrow, c), "ISO-8859-1"))
    return F.when(narrow & F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(c)


def header_filename(c: Column) -> Column:
    """The file name in a content-disposition header: the extended form before the plain one."""
    extended = _blank_to_null(F.regexp_extract(c, r"(?i)filename\*\s*=\s*[^']*'[^']*'([^;]+)", 1))
    plain = _blank_to_null(F.regexp_extract(c, r"(?i)filename\s*=\s*\"?([^\";]+)\"?", 1))
    return F.coalesce(F.try_url_decode(F.trim(extended)), repair_latin1(F.trim(plain)))


def normal_headers(headers: Column) -> Column:
    """A header map with lower-case keys and without nulls."""
    return F.map_filter(F.transform_keys(headers, lambda k, _: F.lower(k)), lambda _, v: v.isNotNull())


def absolute_url(base: str, path: Column) -> Column:
    """A path on the base's host, or a full url, as a full url."""
    from urllib.parse import urlsplit

    site = urlsplit(base)
    folder = base.rsplit("/", 1)[0] if site.path else base
    return (
        F.when(path.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), path)
        .when(F.startswith(path, F.lit("//")), F.concat(F.lit(f"{site.scheme}:"), path))
        .when(F.startswith(path, F.lit("/")), F.concat(F.lit(f"{site.scheme}://{site.netloc}"), path))
        .otherwise(F.concat(F.lit(f"{folder}/"), path))
    )


def csv_cell(c: Column, kind: str) -> Column:
    """A cell as text: null is empty, structures are JSON."""
    if kind.startswith(("array", "map", "struct")):
        c = F.to_json(c)
    return F.coalesce(c.cast("string"), F.lit(""))
