"""What passes through the driver is bounded, and what need not be joined is not."""

from gleanery.functions import numbers, text
from gleanery.functions.patterns import SINGLE_SPACED, SPACE, bounded
from gleanery.functions.spans import positions
from gleanery.operators import entities, language, profile, skew, substring, validate
from gleanery.plans.curate import curate
from gleanery.session import materialise
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_few_rows_are_sent(spark, monkeypatch):
    left, right = (materialise(spark.range(9).select(F.col("id").alias("record_id"), F.col("id").cast("string").alias("k"))) for _ in range(2))
    right = right.select("k")
    assert "BroadcastHashJoin" in _plan(skew.salted_join(left, right, "k", [], "left_semi"))
    monkeypatch.setattr(skew, "SENT_ROWS", 8)
    for hot in ([], ["3"]):
        out = skew.salted_join(left, right, "k", hot, "left_semi")
        assert "Broadcast" not in _plan(out) and out.count() == 9
    assert "Broadcast" not in _plan(left.join(skew.bounded(right), "k"))


def test_strings_are_found_whatever_is_sent(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "the quick fox"), (2, "a quick foxglove " + "x" * 60), (3, "")], "record_id long, text string")
    strings = spark.createDataFrame([("quick fox",), ("glove",), ("uic",), ("x" * 55,)], "string string")
    expected = {(1, "quick fox"), (1, "uic"), (2, "quick fox"), (2, "uic"), (2, "glove"), (2, "x" * 55)}
    for rows in (100, 0):
        monkeypatch.setattr(skew, "SENT_ROWS", rows)
        assert {tuple(r) for r in substring.contained_strings(texts, strings).collect()} == expected


def test_starts_are_the_positions(spark):
    cases = [("aaaaa", "aa"), ("xyx", "x"), ("none", "q"), ("é😀é😀", "😀"), ("a.b\\Ea.b", "a.b"), ("\uffffab ab", "ab")]
    df = spark.createDataFrame(cases, "text string, needle string")
    found = df.select(positions(F.col("text"), F.col("needle")).alias("p")).collect()
    assert [r.p for r in found] == [entities.starts(*c) for c in cases]


def test_familiar_words_are_not_joined(spark):
    df = spark.createDataFrame([(i, "the house zzyx stands") for i in range(9)] + [(9, "qqwv the")], "record_id long, text string")
    lexicon = language.lexicon(df, spark.createDataFrame([("the",), ("house",), ("stand",)], "word string"))
    assert {r.word for r in lexicon.familiar.collect()} == {"the", "house", "stands"}
    tokens = df.select("record_id", F.explode(F.split("text", " ")).alias("word"))
    assert {r.word for r in lexicon.doubtful(tokens).collect()} == {"zzyx", "qqwv"}
    assert language.non_english_ids(df, lexicon).count() == 10


def test_exploded_left_sides_are_not_sent(spark, monkeypatch):
    """The left side, however small it looks, is not what is broadcast when the right one has few rows."""
    left = materialise(spark.range(9).select(F.col("id").alias("record_id"), F.col("id").cast("string").alias("k")))
    right = materialise(spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit("x" * 9).alias("v")))
    for joined in (left.join(skew.bounded(right), "k"), skew.salted_join(left, right, "k", []), skew.salted_join(left, right, "k", ["3"])):
        plan = _plan(joined)
        assert "BuildRight" in plan and "BuildLeft" not in plan
        assert joined.count() == 9
    monkeypatch.setattr(skew, "SENT_BYTES", 3000)
    assert "Broadcast" not in _plan(left.join(skew.bounded(right), "k"))


def test_phrases_are_found_by_their_next_characters(spark):
    texts = spark.createDataFrame([(1, "blue a b"), (2, "the a cd ef"), (3, "a bc  d"), (4, "xa  de"), (5, "a")], "record_id long, text string")
    strings = spark.createDataFrame([("a b",), ("a cd",), ("a cd e",), ("a  d",), ("c  d",), ("e a b",)], "string string")
    expected = {(t.record_id, s.string) for t in texts.collect() for s in strings.collect() if s.string in t.text}
    assert len(expected) == 7
    assert {tuple(r) for r in substring.contained_strings(texts, strings).collect()} == expected


def test_first_records_are_judged_without_sorting_all(spark):
    rows = [(i, "c", "$200", "q " + "x" * i, "a", "Jeopardy!", "1", "2004-01-01") for i in range(50)]
    df = spark.createDataFrame(rows, "record_id long, category string, value string, question string, answer string, round string, show_number string, air_date string")
    out = validate.debug(df, 3)
    assert "Sort" not in _plan(out)
    assert {r.record_id for r in out.collect()} == {0, 1, 2}


def test_mentions_are_searched_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(entities, "materialise", lambda df: seen.append(df) or materialise(df))
    df = spark.createDataFrame([(1, "He met Ada Lovelace. Then Bob left."), (2, "then bob left Ada")], "record_id long, text string")
    freq = entities.entity_frequencies(df)
    assert {tuple(r) for r in freq.collect()} == {("ada lovelace", 1), ("ada", 1), ("he", 1), ("then bob", 1)}
    assert "regexp_extract_all" in str(seen[0]._jdf.queryExecution().optimizedPlan()) and len(seen) == 1


def test_lines_are_parsed_once_for_the_reports(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "lines"), []
    rows = [(i, "c", "$200", f" q {i} ", "a", "Jeopardy!", "1", "2004-01-01") for i in range(9)]
    spark.createDataFrame(rows, "record_id long, category string, value string, question string, answer string, round string, show_number string, air_date string").write.json(path)
    for name in ("summary", "round_distribution", "top_categories", "first_record"):
        report = getattr(profile, name)
        monkeypatch.setattr(profile, name, lambda df, report=report: plans.append(_plan(report(df))) or report(df))
    flag = validate.flag
    monkeypatch.setattr(validate, "flag", lambda df: plans.append(_plan(flag(df))) or flag(df))
    run = curate(spark, path, str(tmp_path / "out"), "jsonl", detectors=[])
    assert len(plans) == 5 and all("FileScan parquet" in p and "FileScan json" not in p for p in plans)
    assert {r.question for r in run.cleaned.records.collect()} == {f"q {i}" for i in range(9)}


# Kinds of white space, and what is none: a zero-width blank, a control character, letters beyond the BMP.
PIECES = ["a", "~", "é", "😀", "\u200b", "\x07", "\x7f", " ", "\t", "\x1c", "\x85", "\xa0", "\u2028", "\u3000"]


def test_single_blanks_are_taken_in_one_go(spark, apply):
    texts = [x + y + z + w for x in PIECES for y in PIECES for z in (" ", "b", "\n") for w in PIECES] + ["", None, "word é " * 300_000, " \t" * 300_000]
    found = apply(text.squeeze_space, texts)
    assert found == apply(lambda c: F.trim(F.regexp_replace(c, f"{SPACE}+", " ")), texts)
    assert apply(lambda c: F.length(F.regexp_replace(c, SINGLE_SPACED, "")), ["word é " * 300_000 + "end"]) == [0]


def test_steps_are_run_for_each_trigger(apply):
    needles = {"_": "[BLANK]", "&amp;": "&", "\\'": "'", "http://x": "[LINK]", "?!": "!", "..": "."} | dict.fromkeys("‘’‚‛′‵", "'") | dict.fromkeys("–—―", "-")
    assert apply(lambda c: text.clean_text(c, "question"), [f"a {n} b" for n in needles]) == [f"a {v} b" for v in needles.values()]


def test_number_words_are_told_apart_by_their_first_letter(apply):
    words = numbers.WORDS.split("|")
    texts = [t for w in words for t in (f"by {w.upper()}.", f"by {w}q", f"q{w} by", w[:-1], w)]
    plain = "(?i)" + bounded(f"{numbers.WORDS}|{numbers.ROMAN}")
    assert apply(numbers.has_number, texts) == apply(lambda c: c.rlike(plain), texts)
    assert len(words) > numbers._by_first_letter(numbers.WORDS).count("(?:") > 8
