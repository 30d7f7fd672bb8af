"""Number mentions as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.numbers import number_tokens, roman_tokens
from gleanery.schema import ID


def number_details(df: DataFrame, text: str = "text") -> DataFrame:
    """Per record: number tokens, Roman candidates and how many there are in all."""
    return (
        df.select(ID, number_tokens(F.col(text)).alias("number_tokens"), roman_tokens(F.col(text)).alias("roman_numerals"))
        .withColumn("total_numbers_found", F.size("number_tokens") + F.size("roman_numerals"))
    )


def number_mentions(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per mention: kind (token or roman), label, text and offsets."""

    def tagged(array, kind, label):
        return F.transform(
            array,
            lambda m: F.struct(
                F.lit(kind).alias("kind"),
                label(m).alias("label"),
                m["text"].alias("mention"),
                m["start"].alias("start"),
                m["end"].alias("end"),
            ),
        )

    tokens = tagged(number_tokens(F.col(text)), "token", lambda m: m["label"])
    romans = tagged(roman_tokens(F.col(text)), "roman", lambda m: F.lit("ROMAN"))
    return df.select(ID, F.inline(F.concat(tokens, romans)))
