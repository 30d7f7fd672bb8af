"""The subset job: detect, count, sample, export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.detectors import Detector, detection_stats, fitted, shown_texts, texts
from gleanery.operators.sample import sample_records
from gleanery.plans.resume import Stages, object_facts
from gleanery.schema import ID
from gleanery.session import materialise
from gleanery.sources.sinks import export_subset


@dataclass
class Subset:
    name: str
    detector: Detector  # fitted to the corpus
    hits: DataFrame
    records: DataFrame
    stats: DataFrame
    exported: int = 0


def build_subset(
    records: DataFrame, detector: Detector, size: int = 1000, seed: int | None = 42, path: str | None = None, stages: Stages | None = None
) -> Subset:
    """Sample ``size`` of the records a detector matches and write them to ``path``.

    The detector is fitted to these records. Ids of the matches are written once; statistics and sample come from them. With ``stages``
    what was fitted, the ids and the sample are tables that a rerun takes up.
    """
    corpus = texts(records, detector)
    name, facts = detector.name, object_facts(detector) if stages else []

    def keep(step: str, make: Callable[[], DataFrame], *more) -> DataFrame:
        return materialise(make()) if stages is None else stages.table(f"{step}-{name}", make, facts, *more)

    detector = fitted(detector, corpus, keep)
    hits = keep("hits", lambda: detector.hits(corpus))
    picked = keep("picked", lambda: sample_records(records, hits, size, seed), size, seed)
    exported = export_subset(picked, path) if path else 0
    return Subset(detector.name, detector, hits, picked, detection_stats(records, hits, picked), exported)


def sample_results(subset: Subset, n: int = 2, detections: int = 3) -> DataFrame:
    """The first records of a subset with the first things the detector found in them."""
    few = materialise(subset.records.orderBy(ID).limit(n))
    found = subset.detector.details(shown_texts(few, subset.detector))
    return few.join(found, ID, "left").select(
        ID,
        F.lit(subset.name).alias("subset"),
        "category",
        F.substring("question", 1, 80).alias("question"),
        "answer",
        F.slice("detected", 1, detections).alias("detected"),
    )
