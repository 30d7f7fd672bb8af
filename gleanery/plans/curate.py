"""The whole run and the capped check run."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gleanery.operators import load, profile, validate
from gleanery.operators.detectors import Detector, EntityDetector, LanguageDetector, accent_detector, number_detector
from gleanery.plans.clean import Cleaned, clean_and_validate, debug_if_low, sample_rejects
from gleanery.plans.report import field_figures, run_report, subset_times, with_speed
from gleanery.plans.resume import Stages, input_facts
from gleanery.plans.subsets import Subset, build_subset
from gleanery.session import materialise
from gleanery.sources.records import read_records
from gleanery.sources.sinks import write_before_after, write_jsonl, write_report


@dataclass
class Run:
    cleaned: Cleaned
    subsets: dict[str, Subset]
    report: DataFrame


def default_detectors(dictionary: DataFrame | None = None, threshold: int = 3) -> list[Detector]:
    """Numbers, non-English words and rare proper nouns.

    Without a dictionary only letters beyond ASCII tell non-English text; see
    ``operators.language.corpus_dictionary`` for one made from English texts.
    """
    language = accent_detector() if dictionary is None else LanguageDetector(dictionary)
    return [number_detector(), language, EntityDetector(threshold)]


def curate(
    spark: SparkSession,
    source: str,
    output: str,
    kind: str = "json",
    dictionary: DataFrame | None = None,
    size: int = 1000,
    seed: int | None = 42,
    threshold: int = 3,
    detectors: list[Detector] | None = None,
    resume: str | None = None,
) -> Run:
    """Load, clean, draw a subset per detector and write all reports below ``output``.

    ``detectors`` replaces the three that ``dictionary`` and ``threshold`` set up. ``resume`` is a shared folder for the keyed input, the
    judged records and what each detector was fitted to and found: after a run that broke off, one with
    the same input and parameters goes on from the last of these that is complete. When a run ends, those of other runs are removed.
    """
    started = time.time()
    stages = None if resume is None else Stages(spark, resume, input_facts(spark, source), kind)

    def keep(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return materialise(make()) if stages is None else stages.table(name, make)

    raw = read_records(spark, source, kind) if stages is None else stages.table("raw", lambda: read_records(spark, source, kind))
    # Seven reports and the judging read these; lines would be parsed and their texts searched at the ends for each.
    records = materialise(load.normalise(raw))
    write_report(
        {
            "load_counts": load.load_counts(raw),
            "null_profile": load.null_profile(records),
            "summary": profile.summary(records),
            "rounds": profile.round_distribution(records),
            "top_categories": profile.top_categories(records),
            "first_record": profile.first_record(records),
            "debug": validate.debug(records, 3),
        },
        f"{output}/load",
    )
    cleaned = Cleaned(keep("judged", lambda: validate.flag(records)))
    suspicious = debug_if_low(records, cleaned)
    if suspicious is not None:
        write_report({"low_retention": suspicious}, f"{output}/validation")
    write_report(cleaned.report, f"{output}/validation")
    write_jsonl(cleaned.records, f"{output}/cleaned")

    detectors = default_detectors(dictionary, threshold) if detectors is None else detectors
    subsets, seconds = {}, {}
    for d in detectors:
        begun = time.time()
        subsets[d.name] = build_subset(cleaned.records, d, size, seed, f"{output}/subsets/{d.name}", stages)
        seconds[d.name] = time.time() - begun
    freq = next((s.detector.freq for s in subsets.values() if hasattr(s.detector, "freq")), None)
    report = run_report(cleaned, list(subsets.values()), freq, threshold)
    report = report.unionByName(field_figures(cleaned.report)).unionByName(subset_times(spark, seconds))
    report = with_speed(report, time.time() - started, len(subsets))
    write_report({"run": report}, f"{output}/report")
    if stages is not None:
        stages.finish()
    return Run(cleaned, subsets, report)


def check(spark: SparkSession, source: str, output: str, limit: int = 1000, kind: str = "json") -> Cleaned:
    """Clean the first ``limit`` records and write them with a before/after table and previews."""
    raw = read_records(spark, source, kind, limit)
    records = load.normalise(raw)
    cleaned = clean_and_validate(records)
    write_jsonl(cleaned.records, f"{output}/cleaned")
    write_report({**cleaned.report, "reject_examples": sample_rejects(cleaned)}, f"{output}/validation")
    write_report(
        {field: validate.cleaning_preview(records, field) for field in ("question", "answer", "category")},
        f"{output}/previews",
    )
    write_before_after(records, cleaned.records, f"{output}/before_after")
    return cleaned
