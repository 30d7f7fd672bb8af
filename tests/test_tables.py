"""The table function against the expression, sketches against exact counts."""

import random

from gleanery.functions import tables
from gleanery.operators import sketches
from gleanery.operators.numbers import number_mentions

TEXTS = [
    "On 3 May 1990s, twenty-first: $1,200.50 or 50% at 7pm; 2nd, 10.20.30x one-ish", "MIX did XL iv", "ſix Kx İ 1st", "€3 £4% ١٢ x²",
    "One,two-three 1990 2999s 99 nineteenth-", "a1b 3.4.5. 1,000,000th", "", None, "😀 12 é7 _8 9_",
]


def test_table_function_in_sql(spark):
    chance = random.Random(1)
    pieces = [*"$€%.,- xsI1٢", "one", "First", "st", "am", "1990", "XIV", "\n"]
    texts = TEXTS + ["".join(chance.choice(pieces) for _ in range(30)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "record_id long, text string")
    tables.register(spark)
    found = spark.sql("select record_id, m.* from {texts}, lateral number_mentions(text) m", texts=df)
    want = number_mentions(df)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_merged_sketches(spark, tmp_path):
    chance = random.Random(2)
    path, seen = str(tmp_path / "sketches"), set()
    for load in range(3):
        rows = [(f"c{chance.randrange(5000)}", None) for _ in range(3000)]
        seen |= {c for c, _ in rows}
        for _ in range(2):  # the second time replaces the first
            sketches.add_load(spark.createDataFrame(rows, "category string, round string"), ["category", "round"], f"day{load}", path)
    counts = {r.column: r.unique_count for r in sketches.merged_counts(spark, path).collect()}
    assert abs(counts["category"] - len(seen)) <= 3 * sketches.STANDARD_ERROR * len(seen) and counts["round"] == 0
    one = {r.column: r.unique_count for r in sketches.merged_counts(spark, path, ["day0"]).collect()}
    assert one["category"] < counts["category"]
