"""Reports over records: every one is a single grouped or global aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.validate import METADATA_STAGE
from gleanery.schema import ID, METADATA_FIELDS, TEXT_FIELDS


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; NULL for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)


def figures(flagged: DataFrame) -> DataFrame:
    """One row with all that the cleaning report needs, in one pass over the judged records: see the functions below."""
    metadata = [f for f in METADATA_FIELDS if f in flagged.columns]
    text = [f for f in TEXT_FIELDS if f in flagged.columns]
    survives = ~F.col("failed").eqNullSafe(METADATA_STAGE)

    def field(f: str) -> Column:
        errors = "meta_errors" if f in metadata else "text_errors"
        kind = "strict_metadata" if f in metadata else "cleaned_text"
        failing = F.exists(errors, lambda e: e.startswith(f"{f}: "))
        return F.struct(
            F.lit(f).alias("field"),
            F.lit(kind).alias("validation_type"),
            F.count(f).alias("non_empty_records"),
            F.count_if(failing).alias("error_records"),
        )

    def effect(f: str) -> Column:
        before = F.when(survives, F.length(F.coalesce(F.col(f), F.lit(""))))
        after = F.when(survives, F.length(f"{f}_clean"))
        return F.struct(
            F.lit(f).alias("field"),
            F.avg(before).alias("original_avg_length"),
            F.avg(after).alias("cleaned_avg_length"),
            F.avg(before - after).alias("avg_reduction"),
            F.count_if(after == 0).alias("empty_after_cleaning"),
            F.count_if(before - after > 20).alias("significantly_reduced"),
        )

    return flagged.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("failed").isNull()).alias("valid_records"),
        F.array(*[field(f) for f in metadata + text]).alias("fields"),
        F.array(*[effect(f) for f in text]).alias("effects"),
    )


def field_stats(flagged: DataFrame) -> DataFrame:
    """Per field: total, filled, NULL, failing and passing records and the failure rate.

    Text errors can only arise among records with valid metadata, but the rate is
    taken over all records.
    """
    return field_stats_of(figures(flagged))


def field_stats_of(row: DataFrame) -> DataFrame:
    """``field_stats`` from ``figures``."""
    return row.select("total_records", F.inline("fields")).select(
        "field",
        "validation_type",
        "total_records",
        "non_empty_records",
        (F.col("total_records") - F.col("non_empty_records")).alias("empty_records"),
        "error_records",
        (F.col("total_records") - F.col("error_records")).alias("valid_records"),
        percent(F.col("error_records"), F.col("total_records")).alias("error_rate"),
    )


def cleaning_summary(flagged: DataFrame) -> DataFrame:
    """Effect of cleaning on each text field, over records with valid metadata."""
    return cleaning_summary_of(figures(flagged))


def cleaning_summary_of(row: DataFrame) -> DataFrame:
    """``cleaning_summary`` from ``figures``."""
    return row.select(F.inline("effects"))


def totals(flagged: DataFrame) -> DataFrame:
    """Processed, valid and removed records and the removal rate."""
    return totals_of(figures(flagged))


def totals_of(row: DataFrame) -> DataFrame:
    """``totals`` from ``figures``."""
    return (
        row.select(F.col("total_records").alias("processed_records"), "valid_records")
        .withColumn("removed_count", F.col("processed_records") - F.col("valid_records"))
        .withColumn("removal_rate", percent(F.col("removed_count"), F.col("processed_records")))
    )


def date_range(df: DataFrame) -> DataFrame:
    """Earliest and latest date, compared as text."""
    return df.agg(F.min("air_date").alias("earliest"), F.max("air_date").alias("latest"))


def round_distribution(df: DataFrame) -> DataFrame:
    return df.filter(F.col("round").isNotNull()).groupBy("round").agg(F.count("*").alias("records"))


def distinct_categories(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count("category").alias("unique_count"))


def top_categories(df: DataFrame, n: int = 5) -> DataFrame:
    """The most frequent categories; ties go to the smaller name."""
    counts = df.filter(F.col("category").isNotNull()).groupBy("category").agg(F.count("*").alias("records"))
    return counts.orderBy(F.desc("records"), "category").limit(n)


def text_lengths(df: DataFrame) -> DataFrame:
    """Average length of question and answer to one decimal."""
    return df.agg(
        F.round(F.avg(F.length("question")), 1).alias("avg_question_length"),
        F.round(F.avg(F.length("answer")), 1).alias("avg_answer_length"),
    )


def first_record(df: DataFrame) -> DataFrame:
    return df.orderBy(ID).limit(1)


def summary(df: DataFrame) -> DataFrame:
    """One row: record count, columns, date range, number of categories and text lengths.

    Goes with ``round_distribution``, ``top_categories`` and ``first_record``.
    """
    return df.agg(
        F.count("*").alias("total_records"),
        F.lit(", ".join(c for c in df.columns if c != ID)).alias("columns"),
        F.min("air_date").alias("earliest"),
        F.max("air_date").alias("latest"),
        F.count_distinct("category").alias("unique_categories"),
        F.round(F.avg(F.length("question")), 1).alias("avg_question_length"),
        F.round(F.avg(F.length("answer")), 1).alias("avg_answer_length"),
    )
