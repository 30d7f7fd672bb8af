"""Number tests and number mentions.

``has_number`` follows a documented contract (digits, written numbers, ordinals,
``7pm``, ``$50``, ``3.14``, ``1990s``, ``twenty-one``, Roman numerals) by one
regular expression. It is no language model: hit rates differ from one.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.patterns import DIGIT, WORD, bounded, isolated
from gleanery.functions.spans import spans

# Words of the plain pattern test.
BASIC_WORDS = (
    "one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen"
    "|eighteen|nineteen|twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion"
    "|first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth"
)
# Words the wider test knows besides.
CARDINALS = "zero|trillion|" + BASIC_WORDS.split("|first")[0]
ORDINALS = (
    "first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth|eleventh|twelfth|thirteenth|fourteenth"
    "|fifteenth|sixteenth|seventeenth|eighteenth|nineteenth|twentieth|thirtieth|fortieth|fiftieth|sixtieth"
    "|seventieth|eightieth|ninetieth|hundredth|thousandth|millionth|billionth"
)
WORDS = f"{CARDINALS}|{ORDINALS}"


def _by_first_letter(terms: str) -> str:
    """The same alternatives, of which only those that begin with the letter at hand are tried. For tests of whole words: the order is another."""
    groups = groupby(sorted(terms.split("|")), key=lambda term: term[0])
    return "|".join(f"{first}(?:{'|'.join(term[1:] for term in group)})" for first, group in groups)


ROMAN = "[mdclxvi]+"
# Canonical numerals up to MMMCMXCIX; the look-ahead rules out the empty one.
STRICT_ROMAN = "(?=[MDCLXVI])M{0,3}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})"

_SUFFIX = "(?:s|st|nd|rd|th|am|pm)?"
_END = f"{_SUFFIX}(?!{WORD})"
# Digit groups joined by points and commas. A group is taken only if the number may
# end behind it or goes on, so the loop needs no backtracking.
_DIGITS = rf"\p{{Nd}}+(?:[.,]\p{{Nd}}++(?=[.,]\p{{Nd}}|{_END}))*+"

BASIC_NUMBER = "(?i)" + bounded(rf"\p{{Nd}}+|{BASIC_WORDS}|{ROMAN}") + r"|\$[\p{Nd},]"
# One digit group of a longer number is enough for the test.
NUMBER = "(?i)" + bounded(rf"\p{{Nd}}+{_SUFFIX}|{_by_first_letter(WORDS)}|{ROMAN}")
NUMBER_TOKEN = (
    rf"(?i)[$€£¥]?(?<!{WORD}){_DIGITS}{_END}%?|"
    + isolated(f"(?:{WORDS})(?:-(?:{WORDS})(?!{WORD}))*+")
)


def any_digit(c: Column) -> Column:
    """Any character that counts as a digit."""
    return F.coalesce(c.rlike(DIGIT), F.lit(False))


def has_roman(c: Column, strict: bool = False) -> Column:
    """A run of Roman numeral letters standing alone.

    By default in any case and without a validity check, so ``I``, ``did`` and
    ``mix`` count. ``strict`` wants canonical upper-case numerals.
    """
    pattern = isolated(STRICT_ROMAN) if strict else "(?i)" + bounded(ROMAN)
    return F.coalesce(c.rlike(pattern), F.lit(False))


def has_basic_number(c: Column) -> Column:
    """Plain pattern test: whole digit groups, dollar amounts, number words, Roman numerals."""
    return F.coalesce(c.rlike(BASIC_NUMBER), F.lit(False))


def has_number(c: Column) -> Column:
    """The contract described above."""
    return F.coalesce(c.rlike(NUMBER), F.lit(False))


def number_tokens(c: Column) -> Column:
    """Number tokens as ``array<struct<text, start, end, label, is_alpha, is_digit>>``."""

    def describe(m: Column) -> Column:
        t = F.lower(m["text"])
        label = (
            F.when(t.rlike("^[$€£¥]"), "MONEY")
            .when(t.endswith("%"), "PERCENT")
            .when(t.rlike(rf"\p{{Nd}}(?:st|nd|rd|th)$|(?:^|-)(?:{ORDINALS})$"), "ORDINAL")
            .when(t.rlike("^[12][0-9]{3}s?$"), "DATE")
            .otherwise("CARDINAL")
        )
        return F.struct(
            m["text"].alias("text"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            label.alias("label"),
            t.rlike(r"^\p{L}+$").alias("is_alpha"),
            t.rlike(f"^{DIGIT}+$").alias("is_digit"),
        )

    return F.transform(spans(c, NUMBER_TOKEN), describe)


def roman_tokens(c: Column) -> Column:
    """Roman numeral candidates as ``array<struct<text, start, end>>``."""
    return spans(c, "(?i)" + isolated(ROMAN))
