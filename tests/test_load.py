import json

import pytest

from gleanery.operators import load, profile
from gleanery.schema import RECORD_COLUMNS
from gleanery.sources.records import read_records, read_word_list
from gleanery.sources.sinks import before_after, export_subset, write_before_after, write_jsonl

ROWS = [
    {"category": " HISTORY ", "value": None, "question": " q1 ", "answer": "a", "round": None, "show_number": "0012", "air_date": "2004-01-02"},
    {"category": " ", "value": "$200", "question": "  ", "answer": "b", "round": "Jeopardy!", "show_number": None, "air_date": None},
    {"category": None, "value": "$400", "question": None, "answer": "c", "round": "Jeopardy!", "show_number": 7, "air_date": "x"},
    {"category": "ART", "value": "$400", "question": "q4", "answer": "d\ne", "round": "Jeopardy!", "show_number": 7, "air_date": "2003-01-02"},
]


@pytest.fixture
def array_file(tmp_path):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(ROWS))
    return str(path)


def test_read_and_normalise(spark, array_file):
    raw = read_records(spark, array_file)
    assert raw.columns == [*RECORD_COLUMNS, "record_id"]
    rows = load.normalise(raw).orderBy("record_id").collect()
    assert [r.category for r in rows] == ["HISTORY", None, "ART"]
    assert [r.value for r in rows] == ["None", "$200", "$400"]
    assert [r.question for r in rows] == ["q1", None, "q4"]
    assert [r["round"] for r in rows] == [None, "Jeopardy!", "Jeopardy!"]
    assert [r.show_number for r in rows] == ["0012", "None", "7"]
    assert [r.air_date for r in rows] == ["2004-01-02", "None", "2003-01-02"]
    counts = load.load_counts(raw).first()
    assert (counts.loaded, counts.kept, counts.removed) == (4, 3, 1)
    nulls = {r["column"]: r.null_count for r in load.null_profile(load.normalise(raw)).collect()}
    assert nulls["category"] == 1 and nulls["round"] == 1 and nulls["value"] == 0


def test_first_rows(spark, array_file):
    assert load.first_rows(read_records(spark, array_file), 2).count() == 2
    assert [r.answer for r in read_records(spark, array_file, limit=2).orderBy("record_id").collect()] == ["a", "b"]


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_records(spark, str(tmp_path / "none.json"))
    path = tmp_path / "short.json"
    path.write_text(json.dumps([{"category": "x", "question": "q"}]))
    with pytest.raises(ValueError, match="Missing required columns.*value.*air_date"):
        read_records(spark, str(path))
    path.write_text("{broken")
    with pytest.raises(ValueError):
        read_records(spark, str(path))
    with pytest.raises(ValueError):
        read_records(spark, str(path), "xml")
    path.write_text(json.dumps(ROWS[0]) + "\n{broken\n")
    with pytest.raises(ValueError):
        read_records(spark, str(path), "jsonl")


def test_late_columns_in_json_lines(spark, tmp_path):
    path = tmp_path / "late.jsonl"
    early = [{k: v for k, v in ROWS[3].items() if k != "value"}] * 1500
    path.write_text("\n".join(json.dumps(r) for r in [*early, ROWS[3]]))
    assert read_records(spark, str(path), "jsonl").filter("value is not null").count() == 1
    path.write_text("\n".join(json.dumps(r) for r in early))
    with pytest.raises(ValueError, match="value"):
        read_records(spark, str(path), "jsonl")


def test_json_lines_and_parquet_round_trip(spark, array_file, tmp_path):
    rows = load.normalise(read_records(spark, array_file))
    lines, table = str(tmp_path / "lines"), str(tmp_path / "table")
    assert write_jsonl(rows, lines) == 3
    assert '"category":null' in "".join(p.read_text() for p in (tmp_path / "lines").glob("part-*"))
    rows.write.parquet(table)
    expected = sorted(map(str, rows.select("record_id", *RECORD_COLUMNS).collect()))
    for path, kind in ((lines, "jsonl"), (table, "parquet")):
        back = read_records(spark, path, kind).select("record_id", *RECORD_COLUMNS)
        assert sorted(map(str, back.collect())) == expected


def test_export_subset(spark, array_file, tmp_path):
    rows = load.normalise(read_records(spark, array_file))
    assert export_subset(rows.limit(0), str(tmp_path / "empty")) == 0
    assert not (tmp_path / "empty").exists()
    assert export_subset(rows, str(tmp_path / "subset")) == 3
    first = json.loads(next((tmp_path / "subset").glob("part-*")).read_text().splitlines()[0])
    assert list(first) == RECORD_COLUMNS


def test_before_after(spark, array_file, tmp_path):
    raw = load.normalise(read_records(spark, array_file))
    out = {r.record_index: r for r in before_after(raw, raw.filter("category = 'ART'")).collect()}
    assert len(out) == 3
    kept = [r for r in out.values() if r.cleaned_category != "REMOVED"]
    assert [(r.original_category, r.cleaned_question, r.cleaned_value) for r in kept] == [("ART", "q4", "$400")]
    write_before_after(raw, raw, str(tmp_path / "csv"), limit=1)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == list(out[kept[0].record_index].asDict())


def test_word_list(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("Apple\napple\nZoo\n")
    assert sorted(r.word for r in read_word_list(spark, str(path)).collect()) == ["apple", "zoo"]


def test_late_partial_and_repeated_keys(spark, tmp_path):
    path, row = tmp_path / "keys.jsonl", ROWS[3]
    late = [row] * 1200 + [row | {"record_id": i} for i in range(300)]
    path.write_text("\n".join(json.dumps(r) for r in late))
    with pytest.raises(ValueError, match="1200 records have no record_id"):
        read_records(spark, str(path), "jsonl")
    path.write_text("\n".join(json.dumps(row | {"record_id": i}) for i in range(1500)))
    assert read_records(spark, str(path), "jsonl").agg({"record_id": "sum"}).first()[0] == 1499 * 750
    for ids in ([1, 1, 2], [1, None, 2]):
        table = str(tmp_path / f"table{ids[1]}")
        rows = [tuple(str(row[c]) for c in RECORD_COLUMNS) + (i,) for i in ids]
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RECORD_COLUMNS) + ", record_id long").write.parquet(table)
        with pytest.raises(ValueError, match="record_id"):
            read_records(spark, table, "parquet")


def test_profile(spark, array_file):
    rows = load.normalise(read_records(spark, array_file))
    summary = profile.summary(rows).first()
    assert (summary.total_records, summary.earliest, summary.unique_categories) == (3, "2003-01-02", 2)
    assert summary.avg_question_length == 2.0
    assert [(r["round"], r.records) for r in profile.round_distribution(rows).collect()] == [("Jeopardy!", 2)]
    assert [r.category for r in profile.top_categories(rows, 1).collect()] == ["ART"]
    assert profile.distinct_categories(rows, approximate=True).first().unique_count == 2
    assert profile.first_record(rows).first().category == "HISTORY"
    assert profile.date_range(rows).first().latest == "None"
    assert profile.text_lengths(rows).first().avg_answer_length == 1.7
