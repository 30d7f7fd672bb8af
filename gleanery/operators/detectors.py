"""Detectors: which records have a feature.

A detector has a ``name``, the ``columns`` it reads, ``hits(df)`` (ids of the
matching records of a table record_id, text) and ``details(df)`` (record_id and
what was found). One that has to know the corpus first also has ``fit(df)``, which returns a
detector for this corpus; its verdicts then hold for any part of the corpus. ``shown``, if
there, names the columns that ``details`` is meant for. Any object with these can be passed to the jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from inspect import signature
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import numbers, words
from gleanery.operators import entities, language, ngrams
from gleanery.operators.profile import percent
from gleanery.schema import ID
from gleanery.session import materialise


class Detector(Protocol):
    name: str
    columns: list[str]

    def hits(self, df: DataFrame) -> DataFrame: ...

    def details(self, df: DataFrame) -> DataFrame: ...


Keep = Callable[[str, Callable[[], DataFrame]], DataFrame]


def written(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Keep a table that a detector makes while it is fitted: as a scratch table."""
    return materialise(make())


def fitted(detector: Detector, df: DataFrame, keep: Keep = written) -> Detector:
    """The detector as it stands for a corpus (record_id, text); ``keep`` says where its tables go, if its ``fit`` takes that."""
    if not hasattr(detector, "fit"):
        return detector
    return detector.fit(df, keep) if "keep" in signature(detector.fit).parameters else detector.fit(df)


def combined_text(df: DataFrame, columns: list[str]) -> Column:
    """The given columns that exist, joined by a blank; NULLs are left out."""
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in columns if c in df.columns])


def texts(df: DataFrame, detector: Detector) -> DataFrame:
    return df.select(ID, combined_text(df, detector.columns).alias("text"))


def shown_texts(df: DataFrame, detector: Detector) -> DataFrame:
    """The texts in which the detector is asked for details."""
    columns = getattr(detector, "shown", None) or detector.columns
    return df.select(ID, combined_text(df, columns).alias("text"))


@dataclass
class ColumnDetector:
    """A detector that is one boolean expression over the text.

    ``found`` gives what it detects in a text as an array of strings.
    """

    name: str
    columns: list[str]
    test: Callable[[Column], Column]
    found: Callable[[Column], Column] | None = None
    shown: list[str] | None = None

    def hits(self, df: DataFrame) -> DataFrame:
        return df.filter(self.test(F.col("text"))).select(ID)

    def details(self, df: DataFrame) -> DataFrame:
        found = self.found(F.col("text")) if self.found else F.array().cast("array<string>")
        return df.select(ID, found.alias("detected"))


def _number_tokens(c: Column) -> Column:
    return numbers.number_tokens(c)["text"]


def digit_detector() -> ColumnDetector:
    columns = ["question", "answer", "category"]
    return ColumnDetector("numbers_test", columns, numbers.any_digit, _number_tokens, columns[:2])


def number_detector(basic: bool = False) -> ColumnDetector:
    """Numbers by the full contract, or by the plain pattern test."""
    columns = ["question", "answer", "category"]
    test = numbers.has_basic_number if basic else numbers.has_number
    return ColumnDetector("numbers", columns, test, _number_tokens, columns[:2])


def accent_detector() -> ColumnDetector:
    """Non-English text without a dictionary: letters beyond ASCII."""
    return ColumnDetector("non_english", ["question", "answer"], words.has_non_ascii, words.non_ascii_chars)


@dataclass
class LanguageDetector:
    """Words outside a dictionary table (word); see ``language.unknown_words`` for ``rules`` and ``letters``."""

    dictionary: DataFrame
    irregular: DataFrame | None = None
    name: str = "non_english"
    columns: list[str] = field(default_factory=lambda: ["question", "answer"])
    rules: DataFrame | None = None
    letters: ngrams.LetterModel | None = None

    def fit(self, df: DataFrame, keep: Keep = written) -> FittedLanguage:
        """Judge the words of a corpus once."""
        lexicon = language.lexicon(df, self.dictionary, irregular=self.irregular, rules=self.rules, letters=self.letters, keep=keep)
        return FittedLanguage(lexicon, self.name, self.columns)

    def hits(self, df: DataFrame) -> DataFrame:
        return self.fit(df).hits(df)

    def details(self, df: DataFrame) -> DataFrame:
        return self.fit(df).details(df)


@dataclass
class FittedLanguage:
    """The words outside the dictionary in one corpus."""

    lexicon: language.Lexicon
    name: str
    columns: list[str]

    def hits(self, df: DataFrame) -> DataFrame:
        return language.non_english_ids(df, self.lexicon)

    def details(self, df: DataFrame) -> DataFrame:
        found = language.non_english_details(df, self.lexicon)
        return found.select(ID, F.col("non_english_words.token").alias("detected"))


@dataclass
class EntityDetector:
    """Rare proper nouns; ``mentions`` replaces the built-in mention finder."""

    threshold: int = entities.THRESHOLD
    mentions: Callable[[DataFrame], DataFrame] | None = None
    name: str = "proper_nouns"
    columns: list[str] = field(default_factory=lambda: ["question", "answer"])

    def fit(self, df: DataFrame, keep: Keep = written) -> FittedEntities:
        """Count the entities of a corpus once."""

        def counted() -> DataFrame:
            return entities.entity_frequencies(df) if self.mentions is None else entities.frequencies_of(self.mentions(df))

        return FittedEntities(keep("frequencies", counted), self.threshold, self.name, self.columns)

    def hits(self, df: DataFrame) -> DataFrame:
        return self.fit(df).hits(df)

    def details(self, df: DataFrame) -> DataFrame:
        return self.fit(df).details(df)


@dataclass
class FittedEntities:
    """The entities of one corpus with their frequencies."""

    freq: DataFrame
    threshold: int
    name: str
    columns: list[str]

    def hits(self, df: DataFrame) -> DataFrame:
        return entities.rare_entity_ids(df, self.freq, self.threshold)

    def details(self, df: DataFrame) -> DataFrame:
        found = entities.rare_entity_details(df, self.freq, self.threshold)
        return found.select(ID, F.col("unusual_entities_found.text").alias("detected"))


def flag_column(df: DataFrame, detector: Detector) -> DataFrame:
    """Add the boolean column ``has_<name>``; only corpus-wide detectors need a join for it."""
    column = f"has_{detector.name}"
    if isinstance(detector, ColumnDetector):
        return df.withColumn(column, detector.test(combined_text(df, detector.columns)))
    hits = detector.hits(texts(df, detector)).select(ID, F.lit(True).alias(column))
    return df.join(hits, ID, "left").withColumn(column, F.coalesce(column, F.lit(False)))


def detection_stats(df: DataFrame, hits: DataFrame, picked: DataFrame) -> DataFrame:
    """Records, matches and their rate; the records picked for the subset and their share of the matches."""
    marks = [source.select(F.lit(i).alias("source")) for i, source in enumerate((df, hits, picked))]
    rate = F.coalesce(percent(F.col("detected_records"), F.col("total_records")), F.lit(0.0))
    names = ("total_records", "detected_records", "subset_size")
    counts = marks[0].union(marks[1]).union(marks[2]).agg(*[F.count_if(F.col("source") == i).alias(n) for i, n in enumerate(names)])
    return counts.select(
        "total_records",
        "detected_records",
        rate.alias("detection_rate"),
        "subset_size",
        (F.col("subset_size") / F.greatest(F.lit(1), F.col("detected_records"))).alias("sampling_ratio"),
    )
