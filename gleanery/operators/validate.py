"""Two-stage validation: metadata first, then the cleaned text of the survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions import rules
from gleanery.functions.text import clean_text
from gleanery.schema import ID, METADATA_FIELDS, RECORD_COLUMNS, TEXT_FIELDS
from gleanery.session import materialise

METADATA_STAGE = "metadata"
TEXT_STAGE = "text"

# Why a record was rejected.
REASONS = {METADATA_STAGE: "Invalid metadata fields", TEXT_STAGE: "Invalid text fields after cleaning"}


def _prefixed(field: str, error: Column) -> Column:
    return F.concat(F.lit(f"{field}: "), error)


def metadata_errors(df: DataFrame, strict_dates: bool = False) -> Column:
    """All metadata errors of a record, in field order; an absent column fails every record."""
    return F.array_compact(
        F.array(
            *[
                _prefixed(f, rules.metadata_error(F.col(f), f, strict_dates))
                if f in df.columns
                else F.lit(f"{f}: Field missing")
                for f in METADATA_FIELDS
            ]
        )
    )


def flag(df: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Judge every record.

    Adds ``meta_errors``; ``question_clean`` and ``answer_clean`` (NULL for records
    whose metadata already failed, which are not cleaned at all); ``text_errors``;
    and ``failed``: the stage that rejected the record, or NULL.
    """
    fields = [f for f in TEXT_FIELDS if f in df.columns]
    passed = F.size("meta_errors") == 0
    df = df.withColumn("meta_errors", metadata_errors(df, strict_dates))
    # As a generator the cleaning runs once; a filter on ``failed`` would otherwise
    # be pushed below it and repeat it for every condition.
    cleaned = F.struct(*[F.when(passed, clean_text(F.col(f), f)).alias(f"{f}_clean") for f in fields])
    df = df.select("*", F.inline(F.array(cleaned)))
    text_errors = F.array_compact(
        F.array(*[F.when(passed, _prefixed(f, rules.text_error(F.col(f"{f}_clean"), f))) for f in fields])
    )
    return df.withColumn("text_errors", text_errors).withColumn(
        "failed", F.when(~passed, METADATA_STAGE).when(F.size("text_errors") > 0, TEXT_STAGE)
    )


def accepted(flagged: DataFrame) -> DataFrame:
    """Records that passed both stages, with cleaned text."""
    cleaned = {f: f"{f}_clean" for f in TEXT_FIELDS}
    columns = [F.col(cleaned.get(c, c)).alias(c) for c in RECORD_COLUMNS if c in flagged.columns]
    return flagged.filter(F.col("failed").isNull()).select(ID, *columns)


def rejects(flagged: DataFrame) -> DataFrame:
    """One row per rejected record: stage, reason, errors and a few of its values.

    Text is shown up to 50 characters, an absent column as ``N/A``. The sampled fields depend on the stage.
    """

    def whole(c: str, missing: str = "None") -> Column:
        return F.coalesce(F.col(c), F.lit(missing)) if c in flagged.columns else F.lit("N/A")

    def shown(c: str, missing: str = "None") -> Column:
        return F.substring(whole(c, missing), 1, 50)

    def sample(**fields: Column) -> Column:
        return F.create_map(*[x for name, c in fields.items() for x in (F.lit(name), c)])

    category = shown("category", "<NA>")
    metadata = sample(
        category=category, value=whole("value"), round=whole("round"), show_number=whole("show_number")
    )
    text = sample(category=category, question_cleaned=shown("question_clean"), answer_cleaned=shown("answer_clean"))
    by_metadata = F.col("failed") == METADATA_STAGE
    return flagged.filter(F.col("failed").isNotNull()).select(
        ID,
        F.col("failed").alias("stage"),
        F.when(by_metadata, REASONS[METADATA_STAGE]).otherwise(REASONS[TEXT_STAGE]).alias("reason"),
        F.when(by_metadata, F.col("meta_errors")).otherwise(F.col("text_errors")).alias("errors"),
        F.when(by_metadata, metadata).otherwise(text).alias("sample"),
    )


def reject_examples(rejected: DataFrame, per_reason: int = 3, errors: int = 2) -> DataFrame:
    """The first rejects of each reason with their first errors, for a printed report.

    The rank filter is applied in every task before the shuffle (window group
    limit), so a reason holding most of the table is no hot spot.
    """
    rank = F.row_number().over(Window.partitionBy("reason").orderBy(ID))
    return (
        rejected.withColumn("rank", rank)
        .filter(F.col("rank") <= per_reason)
        .withColumn("errors", F.slice("errors", 1, errors))
    )


def debug(df: DataFrame, limit: int | None = None, strict_dates: bool = False) -> DataFrame:
    """Field-by-field verdicts, one row per record and field.

    ``limit`` takes the first records by key; without it the whole table is judged.
    Text fields are cleaned whatever the metadata says. ``overall_valid``,
    ``metadata_valid`` and ``text_valid`` repeat the record's verdict.
    """
    if limit is not None:
        # Written, so that only the best rows of each task meet; below the generators Spark would sort the whole table.
        df = materialise(df.orderBy(ID).limit(limit))

    def entry(field, kind, value, cleaned, verdict):
        return F.struct(
            F.lit(field).alias("field"),
            F.lit(kind).alias("field_type"),
            value.alias("value"),
            cleaned.alias("cleaned"),
            verdict["valid"].alias("valid"),
            verdict["errors"].alias("errors"),
            verdict["warnings"].alias("warnings"),
        )

    def shown(c: Column) -> Column:
        return F.substring(F.coalesce(c, F.lit("None")), 1, 50)

    gone = F.lit("MISSING")
    absent = rules.result(F.lit("Field not found in data"))
    nothing = F.lit(None).cast("string")

    present = [f for f in TEXT_FIELDS if f in df.columns]
    df = df.withColumns({f"{f}_clean": clean_text(F.col(f), f) for f in present})
    metadata = [
        entry(f, "metadata", shown(F.col(f)), nothing, rules.validate_metadata_field(F.col(f), f, strict_dates))
        if f in df.columns
        else entry(f, "metadata", gone, nothing, absent)
        for f in METADATA_FIELDS
    ]
    text = [
        entry(
            f, "text", shown(F.col(f)), shown(F.col(f"{f}_clean")), rules.validate_text_field(F.col(f"{f}_clean"), f)
        )
        if f in present
        else entry(f, "text", gone, gone, absent)
        for f in TEXT_FIELDS
    ]
    judged = df.select(ID, F.array(*metadata).alias("metadata"), F.array(*text).alias("text"))
    judged = judged.withColumns(
        {
            "metadata_valid": F.forall("metadata", lambda x: x["valid"]),
            "text_valid": F.forall("text", lambda x: x["valid"]),
        }
    )
    return judged.select(
        ID,
        (F.col("metadata_valid") & F.col("text_valid")).alias("overall_valid"),
        "metadata_valid",
        "text_valid",
        F.inline(F.concat("metadata", "text")),
    )


def cleaning_preview(df: DataFrame, field: str, limit: int | None = 3) -> DataFrame:
    """A field before and after cleaning and whether it changed; one error row for an unknown field."""
    if field not in df.columns:
        return df.sparkSession.createDataFrame([(f"Field {field} not found",)], "error string")
    if limit is not None:
        df = df.orderBy(ID).limit(limit)
    kind = field if field in ("question", "answer", "category") else "general"
    cleaned = F.col(f"{field}_cleaned")
    return df.select(ID, field, clean_text(F.col(field), kind).alias(f"{field}_cleaned")).withColumn(
        "changed", ~F.col(field).eqNullSafe(cleaned)
    )
