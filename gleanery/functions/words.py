"""Word-level expressions for the dictionary test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Latin-1 letters (with the two signs amid them), Latin Extended-A
# and the basic Cyrillic letters.
NON_ASCII = "[à-ÿÀ-ßĀ-žА-я]"

# Words that pass although no dictionary lists them.
ARTIFACTS = ["gon", "na", "wan", "ta", "ok", "okay", "yeah", "yep", "nope", "hmm"]

_IN = r"[\p{L}\p{M}\p{N}_]"
_APOSTROPHE = "['’]"
# A purely alphabetic token. A contraction ending (n't 's 're 'll 've 'd 'm) is cut
# off; any other word glued by an apostrophe, digit or mark is no such token.
ALPHA_WORD = (
    rf"(?<!{_IN})(?<!{_IN}{_APOSTROPHE})\p{{L}}+"
    rf"(?:(?!{_IN}|{_APOSTROPHE}{_IN})"
    rf"|(?={_APOSTROPHE}(?i:s|re|ll|ve|d|m)(?!{_IN}|{_APOSTROPHE}{_IN}))"
    rf"|(?=(?i:n{_APOSTROPHE}t)(?!{_IN}|{_APOSTROPHE}{_IN})))"
)

# Inflection endings and what may stand in their place in the base form.
ENDINGS = [
    ("s", ""), ("es", ""), ("ies", "y"),
    ("ed", ""), ("ed", "e"), ("ied", "y"),
    ("ing", ""), ("ing", "e"),
    ("er", ""), ("er", "e"), ("ier", "y"),
    ("est", ""), ("est", "e"), ("iest", "y"),
    ("ly", ""), ("ly", "le"), ("ily", "y"),
]
# Endings before which a doubled consonant may be undone (running, bigger).
DOUBLING = ["ed", "ing", "er", "est"]
# A base form has at least this many letters.
SHORTEST_STEM = 2


def has_non_ascii(c: Column) -> Column:
    return F.coalesce(c.rlike(NON_ASCII), F.lit(False))


def non_ascii_chars(c: Column) -> Column:
    """The distinct non-ASCII letters of a text, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NON_ASCII), 0)))


def alpha_words(c: Column) -> Column:
    """All purely alphabetic tokens, in order, case kept."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(ALPHA_WORD), 0)


def base_forms(word: Column) -> Column:
    """Candidate base forms of a lower-case word: itself and the word without its endings.

    A rule-based stand-in for a lemmatiser. It over-generates; a word counts as
    known when any candidate is in the dictionary.
    """

    def cut(n: int) -> Column:
        return F.substr(word, F.lit(1), F.length(word) - n)

    forms = [word]
    for ending, replacement in ENDINGS:
        fits = word.endswith(ending) & (F.length(word) >= len(ending) + SHORTEST_STEM)
        forms.append(F.when(fits, F.concat(cut(len(ending)), F.lit(replacement))))
    for ending in DOUBLING:
        n = len(ending)
        last = F.substring(word, -n - 1, 1)
        doubled = (last == F.substring(word, -n - 2, 1)) & ~last.isin(list("aeiou"))
        fits = word.endswith(ending) & (F.length(word) > n + SHORTEST_STEM) & doubled
        forms.append(F.when(fits, cut(n + 1)))
    return F.array_distinct(F.array_compact(F.array(*forms)))
