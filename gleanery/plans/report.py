"""The run report as rows (section, metric, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import entities, profile
from gleanery.plans.clean import Cleaned
from gleanery.plans.subsets import Subset


def _long(df: DataFrame, section: str, **metrics) -> DataFrame:
    pairs = [F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in metrics.items()]
    return df.select(F.lit(section).alias("section"), F.inline(F.array(*pairs)))


def run_report(
    cleaned: Cleaned, subsets: list[Subset], freq: DataFrame | None = None, threshold: int = entities.THRESHOLD
) -> DataFrame:
    """Generation, cleaning and per-subset figures, rates rounded to two decimals.

    ``freq`` adds the number of entities and of rare ones to the report.
    """
    c = F.col
    totals = profile.totals_of(cleaned.figures)
    parts = [
        _long(totals, "generation", original_records=c("processed_records"), cleaned_records=c("valid_records")),
        _long(
            totals,
            "cleaning",
            records_removed=c("removed_count"),
            removal_rate_percent=F.round("removal_rate", 2),
        ),
    ]
    for s in subsets:
        parts.append(
            _long(
                s.stats,
                s.name,
                candidates_found=c("detected_records"),
                detection_rate=F.round("detection_rate", 2),
                subset_size=c("subset_size"),
            )
        )
    if freq is not None:
        parts.append(
            _long(
                entities.frequency_totals(freq, threshold),
                "proper_nouns",
                total_entities_analyzed=c("total_unique_entities"),
                unusual_entities_found=c("unusual_entities_count"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def field_figures(cleaned: dict[str, DataFrame]) -> DataFrame:
    """The field tables of a cleaning report as rows (section, metric, value); a metric names its field first."""
    parts = []
    for section in ("field_stats", "cleaning_summary"):
        df = cleaned[section]
        pairs = [
            F.struct(F.concat_ws(".", "field", F.lit(c)).alias("metric"), F.col(c).cast("double").alias("value"))
            for c, kind in df.dtypes
            if kind != "string"
        ]
        parts.append(df.select(F.lit(section).alias("section"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def subset_times(spark: SparkSession, seconds: dict[str, float]) -> DataFrame:
    """The run time of each subset."""
    rows = [(name, "processing_time", round(s, 2)) for name, s in seconds.items()]
    return spark.createDataFrame(rows, "section string, metric string, value double")


def with_speed(report: DataFrame, seconds: float, subsets: int = 3) -> DataFrame:
    """Add the run time and the records per second over all detectors."""
    cleaned = report.filter((F.col("section") == "generation") & (F.col("metric") == "cleaned_records"))
    return report.unionByName(
        _long(
            cleaned.withColumnRenamed("value", "records"),
            "performance",
            total_processing_time=F.lit(round(seconds, 2)),
            average_speed_records_per_second=F.round(F.try_divide(F.col("records") * subsets, F.lit(seconds)), 0),
        )
    )
