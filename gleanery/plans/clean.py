"""The cleaning job: judge every record once, derive everything else from that table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators import profile, validate
from gleanery.session import materialise


@dataclass
class Cleaned:
    """Views of the judged table."""

    flagged: DataFrame

    @cached_property
    def figures(self) -> DataFrame:
        """``profile.figures``, written when it is first asked for: one pass for all reports."""
        return materialise(profile.figures(self.flagged))

    @property
    def records(self) -> DataFrame:
        return validate.accepted(self.flagged)

    @property
    def rejects(self) -> DataFrame:
        return validate.rejects(self.flagged)

    @property
    def report(self) -> dict[str, DataFrame]:
        return {
            "totals": profile.totals_of(self.figures),
            "field_stats": profile.field_stats_of(self.figures),
            "cleaning_summary": profile.cleaning_summary_of(self.figures),
            "removed_records": self.rejects,
        }

    def low_retention(self) -> bool:
        """Whether fewer than half of the records are left."""
        kept, all_ = profile.totals_of(self.figures).select("valid_records", "processed_records").first()
        return kept < all_ * 0.5


def clean_and_validate(df: DataFrame, strict_dates: bool = False) -> Cleaned:
    """Validate metadata, clean the survivors' text, validate that.

    The judged table is written once; clean records, rejects and all statistics
    read it with the few columns each needs.
    """
    return Cleaned(materialise(validate.flag(df, strict_dates)))


def debug_if_low(df: DataFrame, cleaned: Cleaned, n: int = 5) -> DataFrame | None:
    """Field verdicts of the first records when retention is low."""
    return validate.debug(df, n) if cleaned.low_retention() else None


def sample_rejects(cleaned: Cleaned) -> DataFrame:
    """A few rejects of each reason, for reading."""
    return validate.reject_examples(cleaned.rejects).drop("rank").orderBy("reason", F.col("record_id"))
