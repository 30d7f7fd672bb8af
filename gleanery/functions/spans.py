"""Matches of a pattern together with their offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import let


# Sums run in groups of this size: appending to a growing array is quadratic, and so is only
# done with a group's values and with the totals of the groups.
_GROUP = 64


def _appended(values: Column, added: Callable[[Column], Column], inclusive: bool) -> Column:
    """Running totals of ``added`` over an array, with or without the value itself."""
    zero = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        total = acc["total"] + added(x)
        kept = total if inclusive else acc["total"]
        return F.struct(total.alias("total"), F.concat(acc["out"], F.array(kept)).alias("out"))

    return F.aggregate(values, zero, step, lambda acc: acc["out"])


def running_sum(values: Column) -> Column:
    """Running totals of an ``array<int>``."""

    def run(xs: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(_GROUP))
        groups = F.transform(starts, lambda i: _appended(F.slice(xs, i, F.lit(_GROUP)), lambda x: x, True))
        return let(groups, joined)

    def joined(groups: Column) -> Column:
        before = _appended(groups, lambda g: F.coalesce(F.try_element_at(g, F.lit(-1)), F.lit(0)), False)
        return F.flatten(F.zip_with(groups, before, lambda g, b: F.transform(g, lambda x: x + b)))

    return let(values, run)


def spans(c: Column, pattern: str) -> Column:
    """``array<struct<text, start, end>>`` of all matches, 0-based, end exclusive.

    The gaps between the matches come from splitting on the same pattern; offsets
    are running lengths. ``pattern`` must not match the empty string.
    """
    c = F.coalesce(c, F.lit(""))
    gaps = F.split(c, pattern, -1)

    def place(matches: Column) -> Column:
        # The last gap, after the last match, is dropped.
        sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))
        return F.zip_with(
            matches,
            running_sum(sizes),
            lambda m, end: F.struct(m.alias("text"), (end - F.length(m)).alias("start"), end.alias("end")),
        )

    return let(F.regexp_extract_all(c, F.lit(pattern), 0), place)


def quoted(c: Column) -> Column:
    """``c`` as a literal inside a Java regular expression."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


# A noncharacter, used to mark occurrences; texts holding it take the slower way.
_MARK = "\uffff"


def positions(text: Column, needle: Column) -> Column:
    """0-based starts of the non-overlapping occurrences of ``needle``, left to right."""
    fast = F.split(F.replace(text, needle, F.lit(_MARK)), _MARK, -1)
    exact = F.split(text, quoted(needle), -1)

    def starts(gaps: Column) -> Column:
        before = F.slice(gaps, F.lit(1), F.size(gaps) - 1)
        ends = running_sum(F.transform(before, lambda g: F.length(g) + F.length(needle)))
        return F.transform(ends, lambda end: end - F.length(needle))

    # Most needles occur once; two plain searches settle that.
    def place(first: Column) -> Column:
        again = F.position(needle, text, first + F.length(needle))
        several = let(F.when(text.contains(_MARK), exact).otherwise(fast), starts)
        once = F.when(first > 0, F.array(first - 1)).otherwise(F.array().cast("array<int>"))
        return F.when((first == 0) | (again == 0), once).otherwise(several)

    return let(F.position(needle, text), place)
