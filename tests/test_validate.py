import pytest
from pyspark.sql import functions as F

from gleanery.functions import rules
from gleanery.operators import profile, validate
from gleanery.schema import RECORD_COLUMNS

GOOD = {
    "category": "HISTORY",
    "value": "$200",
    "question": "For the last 8 years",
    "answer": "Copernicus",
    "round": "Jeopardy!",
    "show_number": "4680",
    "air_date": "2004-12-31",
}

FIELDS = [
    ("value", ["$200", "$2,000", "None", " $200 ", "$1,2", "$²"], ["$", "$,", "$1.5", "200", "$-5", "none", "", "$ 5"]),
    ("round", ["Jeopardy!", " Final Jeopardy! ", "Tiebreaker", "Double Jeopardy!"], ["Bonus", "", "jeopardy!"]),
    ("show_number", ["4680", "0012", " 7 ", "²"], ["n/a", "", "4680.0", "-1", "None"]),
    ("category", ["x", "None"], ["", "   ", " "]),
    ("air_date", ["2004-12-31", "soon"], ["", " "]),
    ("mood", ["", "anything"], []),
]


@pytest.mark.parametrize("field,good,bad", FIELDS)
def test_metadata_rules(apply, field, good, bad):
    verdicts = apply(lambda c: rules.validate_metadata_field(c, field), [*good, *bad, None])
    assert [v.valid for v in verdicts] == [True] * len(good) + [False] * (len(bad) + 1)
    assert verdicts[-1].errors == [f"{field} field is missing"]
    assert all(bool(v.errors) != v.valid for v in verdicts)
    assert verdicts[0].warnings == ([f"Unknown metadata field: {field}"] if field == "mood" else [])


def test_messages(apply):
    assert apply(lambda c: rules.metadata_error(c, "value"), [" 200"]) == [
        'Invalid value format: "200" (expected $<number> or "None")'
    ]
    assert apply(lambda c: rules.metadata_error(c, "round"), ["Bonus"]) == [
        "Invalid round: \"Bonus\" (must be one of: ['Jeopardy!', 'Double Jeopardy!', 'Final Jeopardy!', 'Tiebreaker'])"
    ]
    assert apply(lambda c: rules.metadata_error(c, "show_number"), ["x"]) == ['Show number must be a number: "x"']


def test_strict_dates(apply):
    errors = apply(lambda c: rules.metadata_error(c, "air_date", strict_dates=True), ["2004-12-31", "soon"])
    assert errors == [None, 'Invalid date format: "soon" (expected YYYY-MM-DD)']


def test_text_rules(apply):
    values = ["ab", "a", " ", None]
    expected = [None, "Too short after cleaning", "Empty after cleaning", "Required field is missing"]
    assert apply(lambda c: rules.text_error(c, "question"), values) == expected
    assert apply(lambda c: rules.text_error(c, "answer"), values) == [None, None, *expected[2:]]


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        GOOD,
        GOOD | {"value": "$", "round": None},
        GOOD | {"category": None, "question": "x"},
        GOOD | {"question": "_", "answer": "<b></b>"},
        GOOD | {"question": "audio"},
        GOOD | {"question": "<i>a</i> b " + "~" * 5 + "<!--" + "x" * 40 + "-->"},
    ]
    rows = [(i, *[r[c] for c in RECORD_COLUMNS]) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "record_id long, " + ", ".join(f"{c} string" for c in RECORD_COLUMNS))


def test_two_stages(table):
    flagged = {r.record_id: r for r in validate.flag(table).collect()}
    assert flagged[0].failed is None
    assert flagged[1].meta_errors == [
        'value: Invalid value format: "$" (expected $<number> or "None")',
        "round: round field is missing",
    ]
    assert flagged[1].question_clean is None and flagged[1].text_errors == []
    assert flagged[2].failed == "metadata"
    assert flagged[3].question_clean == "[BLANK]"
    assert flagged[3].text_errors == ["answer: Empty after cleaning"]
    assert flagged[4].text_errors == ["question: Empty after cleaning"]
    assert flagged[5].question_clean == "a b ~~~~~"


def test_kept_and_rejected_make_up_the_input(table):
    flagged = validate.flag(table)
    kept = {r.record_id for r in validate.accepted(flagged).collect()}
    rejected = {r.record_id: r for r in validate.rejects(flagged).collect()}
    assert kept == {0, 5} and set(rejected) == {1, 2, 3, 4}
    assert rejected[1].reason == "Invalid metadata fields"
    assert rejected[1].sample == {"category": "HISTORY", "value": "$", "round": "None", "show_number": "4680"}
    assert rejected[2].sample["category"] == "<NA>"
    assert rejected[4].sample == {"category": "HISTORY", "question_cleaned": "", "answer_cleaned": "Copernicus"}
    shown = validate.reject_examples(validate.rejects(flagged), per_reason=1, errors=1).collect()
    assert {(r.record_id, len(r.errors)) for r in shown} == {(1, 1), (3, 1)}


def test_absent_columns(table):
    flagged = validate.flag(table.drop("value", "answer")).orderBy("record_id").first()
    assert flagged.meta_errors == ["value: Field missing"]
    debug = validate.debug(table.drop("value", "answer"), limit=1).collect()
    by_field = {r.field: r for r in debug}
    assert by_field["value"].errors == ["Field not found in data"] and by_field["value"].value == "MISSING"
    assert not by_field["round"].metadata_valid and not by_field["answer"].text_valid


@pytest.mark.parametrize("column", ["value", "category", "question", "answer", "round", "show_number"])
def test_rejects_show_absent_columns(table, column):
    rejected = validate.rejects(validate.flag(table.drop(column))).collect()
    shown = {r.sample.get(column, r.sample.get(f"{column}_cleaned")) for r in rejected}
    assert rejected and shown <= {"N/A", None}


def test_debug(table):
    rows = validate.debug(table, limit=2).collect()
    assert len(rows) == 2 * 7
    assert {r.overall_valid for r in rows if r.record_id == 0} == {True}
    assert {r.metadata_valid for r in rows if r.record_id == 1} == {False}
    assert {r.text_valid for r in rows if r.record_id == 1} == {True}


def test_reports(table):
    flagged = validate.flag(table)
    stats = {r.field: r for r in profile.field_stats(flagged).collect()}
    assert stats["value"].error_records == 1 and stats["value"].valid_records == 5
    assert stats["category"].empty_records == 1
    assert stats["question"].error_records == 1 and round(stats["question"].error_rate, 4) == 16.6667
    totals = profile.totals(flagged).first()
    assert (totals.processed_records, totals.valid_records, totals.removed_count) == (6, 2, 4)
    summary = {r.field: r for r in profile.cleaning_summary(flagged).collect()}
    assert summary["question"].empty_after_cleaning == 1 and summary["question"].significantly_reduced == 1
    assert profile.totals(flagged.limit(0)).first().removal_rate is None


def test_preview(table):
    preview = validate.cleaning_preview(table, "question", limit=None).filter(F.col("changed")).collect()
    assert {r.record_id for r in preview} == {3, 4, 5}
    assert validate.cleaning_preview(table, "mood").first().error == "Field mood not found"
