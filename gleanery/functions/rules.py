"""Validation rules as column expressions.

Every rule yields the error text, or NULL when the value passes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.patterns import DIGIT, DIGITS
from gleanery.functions.text import strip
from gleanery.schema import METADATA_FIELDS, ROUNDS

MONEY = rf"^\$,*{DIGIT}[{DIGITS},]*$"
ALL_DIGITS = f"^{DIGIT}+$"
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def metadata_error(c: Column, field: str, strict_dates: bool = False) -> Column:
    """Error text for one metadata field.

    A missing value fails everywhere. Money is ``None`` or a dollar sign and
    digits, commas ignored. A date only has to be non-empty unless
    ``strict_dates`` asks for YYYY-MM-DD. Unknown fields pass (see
    ``metadata_warning``).
    """
    v = strip(c.cast("string"))
    missing = F.when(c.isNull(), f"{field} field is missing")
    if field == "category":
        return missing.when(v == "", "Category is empty")
    if field == "value":
        text = F.concat(F.lit('Invalid value format: "'), v, F.lit('" (expected $<number> or "None")'))
        return missing.when((v != "None") & ~v.rlike(MONEY), text)
    if field == "round":
        text = F.concat(F.lit('Invalid round: "'), v, F.lit(f'" (must be one of: {ROUNDS})'))
        return missing.when(~v.isin(ROUNDS), text)
    if field == "show_number":
        text = F.concat(F.lit('Show number must be a number: "'), v, F.lit('"'))
        return missing.when(~v.rlike(ALL_DIGITS), text)
    if field == "air_date":
        if strict_dates:
            text = F.concat(F.lit('Invalid date format: "'), v, F.lit('" (expected YYYY-MM-DD)'))
            return missing.when(~v.rlike(ISO_DATE), text)
        return missing.when(v == "", "air_date is empty")
    return missing


def metadata_warning(field: str) -> str | None:
    return None if field in METADATA_FIELDS else f"Unknown metadata field: {field}"


def text_error(c: Column, field: str) -> Column:
    """Error text for a cleaned text field: missing, empty, or a one-character question."""
    v = strip(c.cast("string"))
    rule = F.when(c.isNull(), "Required field is missing").when(v == "", "Empty after cleaning")
    if field == "question":
        rule = rule.when(F.length(v) < 2, "Too short after cleaning")
    return rule


def result(error: Column, warning: str | None = None) -> Column:
    """``struct<valid, errors, warnings>`` from an error text."""
    warnings = F.array(F.lit(warning)) if warning else F.array().cast("array<string>")
    return F.struct(
        error.isNull().alias("valid"),
        F.array_compact(F.array(error)).alias("errors"),
        warnings.alias("warnings"),
    )


def validate_metadata_field(c: Column, field: str, strict_dates: bool = False) -> Column:
    return result(metadata_error(c, field, strict_dates), metadata_warning(field))


def validate_text_field(c: Column, field: str) -> Column:
    return result(text_error(c, field))
