"""Text cleaning as column expressions.

``clean_text`` chains the steps in a fixed order; each step is also usable on
its own. Everything stays inside the JVM.
"""

from __future__ import annotations

import html.entities
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.patterns import NOT_PRINTABLE, SINGLE_SPACED, SPACE, isolated_terms

FIELD_TYPES = ("question", "answer", "category", "general")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Cut Unicode white space at both ends (``F.trim`` cuts blanks only).

    A run inside the text is tried once, from its start, so long runs cost no more than others. Texts with
    a printable character at each end, most of them, are not searched.
    """

    def searched(t: Column) -> Column:
        return F.regexp_replace(t, f"{NOT_PRINTABLE}(?:^{SPACE}++|(?<!{SPACE}){SPACE}++$)", "")

    return let(c, lambda t: F.when(F.concat(F.left(t, F.lit(1)), F.right(t, F.lit(1))).rlike(NOT_PRINTABLE), searched(t)).otherwise(t))


def nonblank(c: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


# ---------------------------------------------------------------- markup

# Possessive groups: Java runs them as loops, so long runs of tags need no stack.
_TAG = (
    r"<(?:/?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|/?[a-zA-Z][^>]*>|!--.*?-->|[!?][^>]*>)"
)
# A script or style that is never closed reaches to the end of the text.
_HIDDEN = r"<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
_END = "\uffff"  # a noncharacter
# What begins with neither ``<`` nor, perhaps, white space is skipped cheaply.
_MARKUP = f"(?=[^!-;=-~])(?is)(?:(?<!{SPACE}){SPACE}++)?+(?:(?:{_HIDDEN}|{_TAG}){SPACE}*+)++"


def html_to_text(c: Column) -> Column:
    """Text nodes of an HTML fragment, stripped and joined by one blank.

    Only texts holding both ``<`` and ``>`` are touched. Script and style bodies
    and comments are dropped; character references are decoded once, as an HTML
    parser does.
    """


    def without_markup(t: Column) -> Column:
        # No tag ends behind the last ``>``; brackets there would each be tried to the end.
        # The mark tells whether a script that is never closed swallowed the end.
        tail = F.regexp_replace(F.substring_index(t, ">", -1), f"^{SPACE}++", "")
        head = F.concat(F.substring(t, F.lit(1), F.length(t) - F.length(tail)), F.lit(_END))
        return let(
            F.regexp_replace(head, _MARKUP, " "),
            lambda h: F.when(h.endswith(_END), F.concat(F.substring(h, F.lit(1), F.length(h) - 1), tail)).otherwise(h),
        )

    text = decode_entities(strip(let(c, without_markup)))
    return F.when(c.contains("<") & c.contains(">"), text).otherwise(c)


def strip_tags(c: Column) -> Column:
    """Remove everything between angle brackets without leaving a blank.

    A bracket that is never closed takes the rest of the text along unchanged, so that
    the brackets behind it are not tried one by one.
    """
    return F.regexp_replace(c, "<[^>]++>|(<[^>]*+$)", "$1")


# ------------------------------------------------- character references

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_NAMES = json.dumps(dict(html.entities.html5))
# Names that HTML also accepts without the closing semicolon; longest first.
_OPEN_NAMES = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_OPEN_NAME = "^(" + "|".join(_OPEN_NAMES) + ")"


def _c1_replacements() -> dict[str, str]:
    """Numeric references which HTML reads as Windows-1252, plus NUL and CR."""
    out = {"0": "\ufffd", "13": "\r"}
    for n in range(0x80, 0xA0):
        try:
            out[str(n)] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            out[str(n)] = chr(n)
    return out


_C1 = json.dumps(_c1_replacements())


def _string_map(text: str) -> Column:
    """A constant map; folded into a literal by the optimiser."""
    return F.from_json(F.lit(text), "map<string,string>")


def _from_code_point(n: Column) -> Column:
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    undefined = (
        n.between(0x1, 0x8)
        | (n == 0xB)
        | n.between(0xE, 0x1F)
        | n.between(0x7F, 0x9F)
        | n.between(0xFDD0, 0xFDEF)
        | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    return F.coalesce(
        _string_map(_C1)[n.cast("string")],
        F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(undefined, "").otherwise(char),
    )


def _decode_reference(ref: Column) -> Column:
    # Long digit strings are beyond Unicode anyway; map them to an invalid code point.
    decimal = F.regexp_extract(ref, "^&#0*([0-9]+)", 1)
    hexadecimal = F.regexp_extract(ref, "^&#[xX]0*([0-9a-fA-F]+)", 1)
    beyond = F.lit(0x110000).cast("long")
    numeric = (
        F.when(decimal != "", F.when(F.length(decimal) > 7, beyond).otherwise(decimal.cast("long")))
        .when(F.length(hexadecimal) > 6, beyond)
        .otherwise(F.conv(hexadecimal, 16, 10).cast("long"))
    )

    name = F.substring(ref, 2, 64)
    open_name = F.regexp_extract(name, _OPEN_NAME, 1)
    names = _string_map(_NAMES)
    named = F.coalesce(
        names[name],
        F.when(open_name != "", F.concat(names[open_name], F.substr(name, F.length(open_name) + 1))),
        ref,
    )
    return F.when(ref.startswith("&#"), let(numeric, _from_code_point)).otherwise(named)


def decode_entities(c: Column) -> Column:
    """Decode HTML character references once, left to right (as ``html.unescape``)."""

    def decode(t: Column) -> Column:
        between = F.split(t, _REFERENCE, -1)
        decoded = F.transform(F.regexp_extract_all(t, F.lit(_REFERENCE), 0), _decode_reference)
        pieces = F.zip_with(between, F.concat(decoded, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
        return F.when(t.contains("&"), F.array_join(pieces, "")).otherwise(t)

    return let(c, decode)


def drop_references(c: Column) -> Column:
    """Remove whatever still looks like a character reference."""
    return F.regexp_replace(c, r"&[#\p{L}\p{N}_]+;", "")


# ------------------------------------------------------ smaller steps


def unescape_quotes(c: Column) -> Column:
    """``\\"`` and ``\\'`` lose their backslash, also when it was doubled."""
    c = F.replace(F.replace(c, F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))
    return F.regexp_replace(c, r"\\(['\"])", "$1")


# Markers without meaning in a question.
MEDIA_MARKERS = "audio|video|seen here|heard here"
WAGER_MARKERS = "daily double|dd"


def drop_media_markers(c: Column) -> Column:
    return F.regexp_replace(c, isolated_terms(MEDIA_MARKERS), "")


def drop_wager_markers(c: Column) -> Column:
    return F.regexp_replace(c, isolated_terms(WAGER_MARKERS), "")


def drop_markers(c: Column) -> Column:
    """Both kinds of marker in one pass; removing one kind cannot create the other."""
    return F.regexp_replace(c, isolated_terms(f"{MEDIA_MARKERS}|{WAGER_MARKERS}"), "")


def mark_blanks(c: Column) -> Column:
    return F.regexp_replace(c, "_+", "[BLANK]")


# Characters a URL may go on with; one class for the alternatives the contract lists. The range $-_ is meant as a range,
# so brackets, colons and question marks belong to the URL while # " ~ { end it.
URL = "https?://[a-z!$-_]+"


def mark_links(c: Column) -> Column:
    return F.regexp_replace(c, URL, "[LINK]")


def drop_bracketed(c: Column) -> Column:
    """Remove ``[...]`` and ``(...)`` within a line."""
    return F.regexp_replace(c, r"\[[^\n\]]*\]|\([^\n)]*\)", "")


APOSTROPHES = "\u2018\u2019\u201a\u201b\u2032\u2035"
DASHES = "\u2013\u2014\u2015"


def _each(c: Column, chars: str, by: str) -> Column:
    """Plain searches for the characters, on the bytes of a text; a regular expression looks at every character."""
    return reduce(lambda t, char: F.replace(t, F.lit(char), F.lit(by)), chars, c)


def straighten_apostrophes(c: Column) -> Column:
    return _each(c, APOSTROPHES, "'")


def straighten_dashes(c: Column) -> Column:
    return _each(c, DASHES, "-")


def straighten_quotes(c: Column) -> Column:
    """Curly double quotes to ASCII. Not part of the default cleaning."""
    return _each(c, "\u201c\u201d", '"')


def collapse_punctuation(c: Column) -> Column:
    """A run of ``.!?`` shrinks to its last character."""
    return F.regexp_replace(c, "[.!?]+([.!?])", "$1")


def squeeze_space(c: Column) -> Column:
    """White space runs become one blank; none is left at the ends."""
    # What is spaced already is taken in one go; a search would start anew at every character. The blank set at the end is trimmed.
    return F.trim(F.regexp_replace(c, rf"({SINGLE_SPACED})(?:{SPACE}++|\z)", "$1 "))


# What the steps of the cleaning but markers, brackets and white space look for; most texts hold none of it.
_TRIGGERS = ["http", *"_&\\", *DASHES, *APOSTROPHES, *(a + b for a in ".!?" for b in ".!?")]


def clean_text(c: Column, field_type: str = "general", fix_quotes: bool = False) -> Column:
    """Clean one text column; NULL becomes the empty string.

    ``field_type`` chooses the markup and marker rules. Curly double quotes are
    kept unless ``fix_quotes`` is set.
    """
    if field_type not in FIELD_TYPES:
        raise ValueError(f"unknown field type: {field_type}")
    c = F.coalesce(c.cast("string"), F.lit(""))
    if field_type in ("question", "answer"):
        c = html_to_text(c)
    else:
        c = F.when(c.contains("<") & c.contains(">"), strip_tags(c)).otherwise(c)


    def every_step(t: Column) -> Column:
        t = unescape_quotes(decode_entities(t))
        if field_type == "question":
            t = mark_links(mark_blanks(drop_markers(t)))
        elif field_type == "answer":
            t = mark_links(t)
        elif field_type == "category":
            t = F.upper(drop_bracketed(t))
        if fix_quotes:
            t = straighten_quotes(t)
        t = collapse_punctuation(straighten_dashes(straighten_apostrophes(t)))
        return squeeze_space(drop_references(t))

    def few_steps(t: Column) -> Column:
        if field_type == "question":  # a marker may go between two signs
            t = let(t, lambda u: let(drop_markers(u), lambda m: F.when(F.length(m) < F.length(u), collapse_punctuation(m)).otherwise(m)))
        return squeeze_space(straighten_quotes(t) if fix_quotes else t)

    if field_type == "category":
        return every_step(c)
    return let(c, lambda t: F.when(reduce(Column.__or__, map(t.contains, _TRIGGERS)), every_step(t)).otherwise(few_steps(t)))
