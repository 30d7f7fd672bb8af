import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from gleanery.operators import sample as S
from gleanery.operators.detectors import ColumnDetector, LanguageDetector, detection_stats, digit_detector, flag_column
from gleanery.plans.curate import check, curate
from gleanery.plans.subsets import build_subset, sample_results
from gleanery.schema import RECORD_COLUMNS
from gleanery.streaming.records import flagged_records, record_stream, write_stream

# A digit in one of the columns that the detector reads, in turn; every sixth row has none.
DIGIT_ROWS = [
    tuple(f"{word} {i * 37 + 5}" if i % 6 == at else word for at, word in enumerate(("CARGO", "the tide was low", f"Noted off Cape {chr(65 + i)}lder")))
    for i in range(12)
]
WITH_DIGITS = sum(i % 6 < 3 for i in range(12))


def record(category, question, answer, i):
    return {
        "category": category, "value": f"${200 * (i + 1)}", "question": question, "answer": answer,
        "round": "Jeopardy!", "show_number": str(i + 1), "air_date": "2023-01-01",
    }


@pytest.fixture(scope="module")
def digits(spark):
    rows = [(i, *[record(*r, i)[c] for c in RECORD_COLUMNS]) for i, r in enumerate(DIGIT_ROWS)]
    return spark.createDataFrame(rows, "record_id long, " + ", ".join(f"{c} string" for c in RECORD_COLUMNS))


def expected_sample(n, size, seed):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))[:size]


def ids(df):
    return sorted(r.record_id for r in df.collect())


def test_samples(spark, monkeypatch):
    candidates = spark.range(500).withColumnRenamed("id", "record_id")
    assert ids(S.sample_ids(candidates, 20)) == sorted(expected_sample(500, 20, 42))
    assert ids(S.sample_ids(candidates.repartition(7), 20)) == sorted(expected_sample(500, 20, 42))
    assert ids(S.sample_ids(candidates, 20, seed=1)) == sorted(expected_sample(500, 20, 1))
    assert S.sample_ids(candidates, 20, seed=None).count() == 20
    assert S.sample_ids(candidates, 1000).count() == 500
    assert S.sample_ids(candidates.limit(0), 10).count() == 0
    monkeypatch.setattr(S, "_BUCKET_DIGITS", 1)
    for size in (20, 137, 500, 1000):
        assert ids(S.sample_ids(candidates, size)) == sorted(expected_sample(500, size, 42))


def test_digit_subset(spark, digits, tmp_path):
    subset = build_subset(digits, digit_detector(), size=3, path=str(tmp_path / "out"))
    assert subset.hits.count() == WITH_DIGITS and subset.records.count() == 3 and subset.exported == 3
    stats = subset.stats.first()
    assert (stats.total_records, stats.detected_records, stats.detection_rate, stats.subset_size) == (12, WITH_DIGITS, 50.0, 3)
    assert stats.sampling_ratio == 3 / WITH_DIGITS
    assert build_subset(digits, digit_detector(), size=2).records.count() == 2
    shown = sample_results(subset).collect()
    assert len(shown) == 2 and all(r.detected == re.findall(r"\d+", f"{r.question} {r.answer}") for r in shown)


def test_no_match(digits, tmp_path):
    nothing = ColumnDetector("nothing", ["question"], lambda c: c.contains("zzz"))
    subset = build_subset(digits, nothing, path=str(tmp_path / "none"))
    assert subset.exported == 0 and not (tmp_path / "none").exists()
    stats = detection_stats(digits.limit(0), subset.hits, subset.records).first()
    assert (stats.detection_rate, stats.subset_size, stats.sampling_ratio) == (0.0, 0, 0.0)


def test_flag_columns(spark, digits):
    assert flag_column(digits, digit_detector()).filter("has_numbers_test").count() == WITH_DIGITS
    words = spark.createDataFrame([("the",), ("tide",), ("was",), ("noted",)], "word string")
    flagged = flag_column(digits, LanguageDetector(words))
    assert flagged.count() == 12 and flagged.filter("has_non_english").count() == 12  # low


@pytest.fixture
def source(tmp_path):
    rows = [record(*r, i) for i, r in enumerate(DIGIT_ROWS)]
    rows += [record("ART", "<i>seen here</i> ___ &amp; café", "Osk", 7), record("ART", "_", "", 8)]
    rows += [record("ART", None, "a", 9), record("ART", "audio", "b", 10), record("Y", "Bonus", "b", 11) | {"round": "Bonus"}]
    path = tmp_path / "in.json"
    path.write_text(json.dumps(rows))
    return str(path)


def read_report(spark, path):
    return spark.read.json(path)


def test_whole_run(spark, source, tmp_path):
    out = str(tmp_path / "out")
    run = curate(spark, source, out, size=2)
    assert run.cleaned.records.count() == 13 and run.cleaned.rejects.count() == 3
    assert {n: s.records.count() for n, s in run.subsets.items()} == {"numbers": 2, "non_english": 1, "proper_nouns": 2}
    assert run.subsets["numbers"].hits.count() == WITH_DIGITS
    report = {(r.section, r.metric): r.value for r in read_report(spark, f"{out}/report/run").collect()}
    assert report["generation", "original_records"] == 16 and report["cleaning", "removal_rate_percent"] == 18.75
    assert report["numbers", "candidates_found"] == WITH_DIGITS and report["proper_nouns", "total_entities_analyzed"] > 5
    assert report["performance", "total_processing_time"] > 0 and report["numbers", "processing_time"] > 0
    assert report["field_stats", "value.error_records"] == 0 and report["cleaning_summary", "question.empty_after_cleaning"] >= 1
    clean = read_report(spark, f"{out}/cleaned").filter("category = 'ART'").first()
    assert clean.question == "[BLANK] & café"
    assert read_report(spark, f"{out}/subsets/numbers").columns == sorted(RECORD_COLUMNS)
    assert read_report(spark, f"{out}/validation/totals").first().removed_count == 3
    assert read_report(spark, f"{out}/load/load_counts").first().removed == 1
    assert not (tmp_path / "out" / "validation" / "low_retention").exists()


def test_whole_run_with_own_detectors(spark, source, tmp_path):
    accents = ColumnDetector("accents", ["question"], lambda c: c.contains("é"))
    run = curate(spark, source, str(tmp_path / "own"), detectors=[accents])
    assert list(run.subsets) == ["accents"] and run.subsets["accents"].records.count() == 1


def test_check_run(spark, source, tmp_path):
    out = str(tmp_path / "check")
    cleaned = check(spark, source, out, limit=6)
    assert cleaned.records.count() == 6
    pairs = spark.read.option("header", True).csv(f"{out}/before_after")
    assert pairs.count() == 6 and pairs.filter("cleaned_question = 'REMOVED'").count() == 0


def test_low_retention(spark, digits):
    from gleanery.plans.clean import clean_and_validate, debug_if_low

    spoiled = digits.withColumn("value", F.when(F.col("record_id") > 1, "bad").otherwise(F.col("value")))
    assert debug_if_low(digits, clean_and_validate(digits)) is None
    assert debug_if_low(spoiled, clean_and_validate(spoiled), 2).count() == 14


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [record(*r, i) | {"record_id": i} for i, r in enumerate(DIGIT_ROWS)]
    rows.append(record("ART", "olé", "y", 19) | {"record_id": 19})
    rows.append(record("ART", "bad", "y", 20) | {"record_id": 20, "value": "5"})
    (folder / "a.json").write_text("\n".join(json.dumps(r) for r in rows))
    stream = flagged_records(record_stream(spark, str(folder)))
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    out = {r.record_id: r for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert set(out) == {*range(12), 19}
    assert out[0].has_numbers and not out[19].has_numbers and out[19].has_non_ascii
