"""Table functions for SQL: ``select ... from texts, lateral number_mentions(text)``."""

from __future__ import annotations

from collections.abc import Iterator

import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gleanery.functions.numbers import ORDINALS, WORDS

_COLUMNS = 'kind string, label string, mention string, start int, `end` int'


def _any_case(pattern: str) -> str:
    """Letters of A to Z in either case; no other letter is taken for one of them."""
    return regex.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", pattern)


_W = r"[\p{L}\p{N}_]"
_SUFFIX = _any_case("(?:s|st|nd|rd|th|am|pm)") + "?"
_END = rf"{_SUFFIX}(?!{_W})"
_WORD = f"(?:{_any_case(WORDS)})"
_TOKEN = regex.compile(
    rf"[$€£¥]?(?<!{_W})\p{{Nd}}+(?:[.,]\p{{Nd}}++(?=[.,]\p{{Nd}}|{_END}))*+{_END}%?|(?<!{_W}){_WORD}(?:-{_WORD}(?!{_W}))*+(?!{_W})"
)
_ROMAN = regex.compile(rf"(?<!{_W})[mdclxviMDCLXVI]+(?!{_W})")
_LABELS = [
    ("MONEY", regex.compile("[$€£¥]")),
    ("PERCENT", regex.compile("(?s:.*)%$")),
    ("ORDINAL", regex.compile(rf"(?s:.*)(?:\p{{Nd}}(?:st|nd|rd|th)|(?:^|-)(?:{ORDINALS}))$")),
    ("DATE", regex.compile("[12][0-9]{3}s?$")),
]


def found_in(text: str) -> list[tuple[str, str, str, int, int]]:
    """(kind, label, mention, start, end) of the number tokens and Roman numerals of a text, as ``operators.numbers.number_mentions`` has them."""
    rows = []
    for m in _TOKEN.finditer(text):
        label = next((name for name, pattern in _LABELS if pattern.match(m[0].lower())), "CARDINAL")
        rows.append(("token", label, m[0], m.start(), m.end()))
    return rows + [("roman", "ROMAN", m[0], m.start(), m.end()) for m in _ROMAN.finditer(text)]


class _NumberMentions:
    def eval(self, text: str | None) -> Iterator[tuple]:
        if text:
            yield from found_in(text)


def register(spark: SparkSession) -> None:
    """Make ``number_mentions(text)`` known to SQL: one row per mention, none for a null or empty text.

    Rows travel by Arrow; Spark has no lateral joins with functions that take whole Arrow arrays.
    """
    spark.udtf.register("number_mentions", F.udtf(_NumberMentions, returnType=_COLUMNS, useArrow=True))
