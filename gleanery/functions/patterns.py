"""Character classes and regular expressions shared by the operators.

All of them mean the same to ``java.util.regex`` and RE2. ``\\b`` and ``\\s``
are avoided: their Unicode reach depends on the engine and the Java version.
"""

from __future__ import annotations

import sys

# Unicode white space as str.strip() sees it.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"

# Words with one blank between them, up to white space that is more than that or to the end: possessive, so a loop (Java only).
SINGLE_SPACED = rf"(?:[!-~]++| (?!{SPACE})|[^ -~{SPACE[1:-1]}]++)*+"

# Cheap look-ahead which skips printable ASCII before a costlier class is tried.
NOT_PRINTABLE = "(?=[^!-~])"

# A word character and what may stand next to a word.
WORD = r"[\p{L}\p{N}_]"
LEFT = r"(?:^|[^\p{L}\p{N}_])"
RIGHT = r"(?:$|[^\p{L}\p{N}_])"


def bounded(body: str) -> str:
    """``body`` as a whole word, for boolean tests (the neighbours are consumed)."""
    return f"{LEFT}(?:{body}){RIGHT}"


def isolated(body: str) -> str:
    """``body`` as a whole word by look-around, for extraction and replacement (Java only)."""
    return rf"(?<!{WORD})(?:{body})(?!{WORD})"


def isolated_terms(terms: str) -> str:
    """``isolated`` for an alternation of fixed terms.

    Upper and lower case count the same. A cheap test of the first letter comes
    before the alternation, and the left neighbour is looked at only after a term
    has matched; a look-behind at every character makes the plain form slow.
    """
    first = "".join(sorted({c for term in terms.split("|") for c in (term[0].lower(), term[0].upper())}))
    return rf"(?=[{first}])(?i:{terms})(?<!{WORD}(?i:{terms}))(?!{WORD})"


def _digit_class() -> str:
    """Characters str.isdigit() accepts: the decimal digits plus superscripts, circled digits etc."""
    extra = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit() and not chr(c).isdecimal()]
    ranges: list[list[int]] = []
    for c in extra:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return r"\p{Nd}" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


DIGITS = _digit_class()
DIGIT = f"[{DIGITS}]"
