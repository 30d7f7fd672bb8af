from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.operators.skew import hot_keys, salted_join
from gleanery.operators.substring import contained_strings


def search(spark, texts, strings, window):
    t = spark.createDataFrame(list(enumerate(texts)), "record_id long, text string")
    s = spark.createDataFrame([(x,) for x in strings], "string string")
    return sorted((r.record_id, r.string) for r in contained_strings(t, s, window).collect())


def brute(texts, strings):
    return sorted((i, s) for i, t in enumerate(texts) for s in strings if s in t)


def test_against_brute_force(spark):
    texts = [
        "the new york times",
        "renew yorkshire",
        "a  new  york",
        "new\nyork new york",
        "",
        "x" * 300 + " of new yor",
        "ha ha ha ha ha ha ha ha",
        "to be or not to be that is the question whether tis nobler in the mind",
        "中文没有空格的句子",
        "a.b (c) \\E [d]",
        "new york",
    ]
    strings = [
        "new york", "new", "york", "ork", "he", "w y", "n y", "x" * 100, "x" * 301, "ha ha", "ha ha ha ha ha ha ha ha",
        "to be or not to be that is the question whether tis nobler", "没有", "句子", "b (c) \\E", "\\E [d]", ".",
        "or not to be that is the question whether tis nobler in the mind of", "yorkshire", "of new yor", "k", "new yorks",
    ]
    for window in (1, 3, 8, 48):
        assert search(spark, texts, strings, window) == brute(texts, strings)


def test_only_words_or_only_phrases_or_nothing(spark):
    texts = ["ab cd ef", "abc"]
    assert search(spark, texts, ["b"], 48) == [(0, "b"), (1, "b")]
    assert search(spark, texts, ["b cd e"], 48) == [(0, "b cd e")]
    assert search(spark, texts, [], 48) == []
    assert search(spark, [], ["b"], 48) == []


letters = st.text(alphabet="ab ", max_size=24)
needles = st.text(alphabet="ab ", min_size=1, max_size=9).map(str.strip).filter(bool)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(letters, min_size=1, max_size=40), st.sets(needles, min_size=1, max_size=30), st.sampled_from([2, 48]))
def test_property(spark, texts, strings, window):
    assert search(spark, texts, strings, window) == brute(texts, strings)


def test_ids_only(spark):
    texts = ["abc de", "xbcx", "de fgh", "e fg", "", "de", None]
    df = spark.createDataFrame(list(enumerate(texts)), "record_id long, text string")
    strings = spark.createDataFrame([("bc",), ("e fg",), ("zz",)], "string string")
    assert sorted(r.record_id for r in contained_strings(df, strings, ids_only=True).collect()) == [0, 1, 2, 3]


def test_salted_join_equals_the_plain_join(spark):
    left = spark.range(3000).select(F.col("id").alias("record_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3), ("none", 4)], "k string, v int")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "k")
    assert hot == ["hot"]
    for how in ("inner", "left", "left_semi"):
        plain = sorted(map(str, left.join(right, "k", how).select("record_id", "k").collect()))
        salted = salted_join(left, right, "k", hot, how)
        assert sorted(map(str, salted.select("record_id", "k").collect())) == plain
    assert hot_keys(counts.limit(0), "k") == []
