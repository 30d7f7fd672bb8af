import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gleanery.functions import numbers as N
from gleanery.functions.spans import positions, spans
from gleanery.operators.detectors import combined_text, digit_detector, texts
from gleanery.operators.numbers import number_details, number_mentions
from pyspark.sql import functions as F

# What stands in one of the columns, and whether the plain pattern and the wider contract take it.
FOUND = {
    "": (False, False), "rope": (False, False), "did": (True, True), "Mix": (True, True), "XL": (True, True), "XLs": (False, False),
    "4": (True, True), "a4": (False, False), "4a": (False, False), "80s": (False, True), "3rd": (False, True), "9pm": (False, True),
    "£3": (True, True), "$,": (True, False), "zero": (False, True), "Nine": (True, True), "ninety-nine": (True, True),
    "eleventh": (False, True), "tenth": (True, True), "tenths": (False, False), "x_1": (False, False), "٣": (True, True),
}


def test_wherever_it_stands(spark):
    columns = ["question", "answer", "category"]
    rows = []
    for word in FOUND:
        for at in range(3):
            rows.append((len(rows), *[f"wet {word} rope" if i == at else "tea" for i in range(3)]))
    df = spark.createDataFrame(rows, "record_id long, question string, answer string, category string")
    text = combined_text(df, columns)
    out = df.select("record_id", N.has_basic_number(text).alias("basic"), N.has_number(text).alias("full")).orderBy("record_id")
    assert [(r.basic, r.full) for r in out.collect()] == [f for f in FOUND.values() for _ in range(3)]


def test_any_digit(spark):
    rows = [(1, "berth 6", None), (2, "no", "x²"), (3, None, None), (4, "①", ""), (5, "½", "")]
    df = spark.createDataFrame(rows, "record_id long, question string, answer string")
    hits = digit_detector().hits(texts(df, digit_detector()))
    assert sorted(r.record_id for r in hits.collect()) == [1, 2, 4]


def test_contract(apply):
    yes = ["five", "twenty-one", "First", "123", "7pm", "3.14", "$50", "twenty-first", "1990s", "50%", "2nd", "did", "I", "mild mix"]
    no = ["", None, "H2O", "blue sky", "someone", "tension", "a1b"]
    assert apply(N.has_number, yes + no) == [True] * len(yes) + [False] * len(no)


def test_roman(apply):
    texts = ["Louis XIV", "I did", "éviter", "mix", "IIII", "vi", "XIV."]
    assert apply(N.has_roman, texts) == [True, True, False, True, True, True, True]
    assert apply(lambda c: N.has_roman(c, strict=True), texts) == [True, True, False, False, False, False, True]


def test_tokens(apply):
    text = "On 3 May 1990s, twenty-first: $1,200.50 or 50% at 7pm; 2nd, 10.20.30x one-ish"
    out = [(t.text, t.label) for t in apply(N.number_tokens, [text])[0]]
    assert out == [
        ("3", "CARDINAL"), ("1990s", "DATE"), ("twenty-first", "ORDINAL"), ("$1,200.50", "MONEY"), ("50%", "PERCENT"),
        ("7pm", "CARDINAL"), ("2nd", "ORDINAL"), ("10.20", "CARDINAL"), ("one", "CARDINAL"),
    ]
    for t in apply(N.number_tokens, [text])[0]:
        assert text[t.start : t.end] == t.text


def test_details(spark):
    df = spark.createDataFrame([(1, "Berths 6 and, by the old count, VI"), (2, None)], "record_id long, text string")
    rows = {r.record_id: r for r in number_details(df).collect()}
    assert rows[1].total_numbers_found == 2 and rows[1].number_tokens[0].is_digit
    assert (rows[1].roman_numerals[0].start, rows[1].roman_numerals[0].end) == (32, 34)
    assert rows[2].total_numbers_found == 0
    assert {(r.kind, r.mention) for r in number_mentions(df).collect()} == {("token", "6"), ("roman", "VI")}


def test_long_texts_do_not_overflow_the_stack(apply):
    lists = ",".join(str(i) for i in range(30000))
    words = " ".join(["One"] * 30000)
    tokens = apply(N.number_tokens, [lists, words, "one-" * 20000 + "two"])
    assert [len(t) for t in tokens] == [1, 30000, 1]
    assert apply(N.has_number, [lists, words]) == [True, True]


pieces = st.sampled_from(["a", "aa", "é", "😀", " ", "12", "x", ".", "b\n"])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, max_size=200).map("".join), min_size=1, max_size=30))
def test_spans_property(apply, texts):
    out = apply(lambda c: spans(c, "[a-z0-9]+"), texts)
    for text, found in zip(texts, out, strict=True):
        expected = [(m.group(), m.start(), m.end()) for m in re.finditer("[a-z0-9]+", text)]
        assert [tuple(s) for s in found] == expected


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, max_size=30).map("".join), min_size=1, max_size=30), st.sampled_from(["a", "aa", ".", "😀", "￿", "\\E"]))
def test_positions_property(apply, texts, needle):
    texts = [*texts, "aaaaa", "￿aa￿"]
    out = apply(lambda c: positions(c, F.lit(needle)), texts)
    assert out == [[m.start() for m in re.finditer(re.escape(needle), t)] for t in texts]
