"""Recurring lines on small documents."""

import random

import pytest

from gleanery.llm import template_lines

DOCS = "doc_id long, text string, line string, t int"  # two names that the operator uses itself


def dropped(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    out = template_lines.drop_recurring_lines(df)
    assert out.select("row.*").columns == df.columns
    return sorted(((r.row.doc_id, r.row.text, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)


def own(i):
    return " ".join(chr(97 + (i * 5 + k) % 26) * (k + 2) for k in range(9))


def test_variable_fields_and_the_first_document(spark):
    line = "Page {} of 10, printed on 2024-01-{} by the {} office for all"
    rows = [(i, f"{own(i)}\n{line.format(i, i, 'main')}\nend") for i in range(5)]
    out = dropped(spark, rows)
    assert out[0][2] == rows[0][1] and out[0][4] == 0
    assert [(r[2], r[3], r[4]) for r in out[1:]] == [(f"{own(i)}\nend", 3, 1) for i in range(1, 5)]


def test_words_that_vary_without_digits(spark):
    names = ["Anna", "Bert", "Carl", "Dora", "Emil"]
    rows = [(i, f"{own(i)}\nThis article was written by {n} for our readers") for i, n in enumerate(names)]
    out = dropped(spark, rows)
    assert [r[4] for r in out] == [0, 1, 1, 1, 1]


def test_same_leaf_is_not_enough(spark):
    rows = [(i, " ".join(["it is the", *[f"{w}{chr(97 + i)}" for w in ("red", "big", "old", "new", "odd", "wet")]])) for i in range(6)]
    assert all(r[4] == 0 for r in dropped(spark, rows))


@pytest.mark.parametrize("line", ["one two three four five", "1 2 3", "", " \t"])
def test_short_lines_of_few_documents_stay(spark, line):
    assert all(r[4] == 0 for r in dropped(spark, [(i, f"{own(i)}\n{line}") for i in range(5)]))


def test_defined_cases(spark):
    line = "these seven words stand in all documents"
    long = "\n".join([line] * 3000) + "\n" + "z" * 200_000 + " " + "1" * 200_000
    rows = [(None, line), (None, None), (4, None), (5, ""), (6, line), (6, line), (7, f" {line}  "), (8, line), (9, long), (10, "\n\n")]
    out = {(r[0], r[1]): r[2:] for r in dropped(spark, rows)}
    assert out[(6, line)] == (line, 1, 0)  # the smallest id is first, repeated rows are one document
    assert out[(7, f" {line}  ")] == ("", 1, 1) and out[(8, line)] == ("", 1, 1) and out[(None, line)] == ("", 1, 1)
    assert out[(9, long)] == (long.split("\n")[-1], 3001, 3000)
    assert out[(None, None)] == (None, 0, 0) and out[(5, "")] == ("", 1, 0) and out[(10, "\n\n")] == ("\n\n", 3, 0)
    assert dropped(spark, []) == []


def n_dropped(spark, texts):
    out = template_lines.drop_recurring_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return [r.n_dropped for r in out.orderBy("row.doc_id").collect()]


@pytest.mark.parametrize(("words", "docs"), [(1, 96), (3, 24), (5, 6), (6, 3), (12, 2)])
def test_lines_of_any_length_count_from_so_many_documents(spark, words, docs):
    line = " ".join(chr(97 + k % 26) * 3 for k in range(words))
    texts = [f"{'q' * (i + 1)} {i}x\n\n{line}" for i in range(docs)]
    assert n_dropped(spark, texts) == [0] + [1] * (docs - 1)
    assert n_dropped(spark, texts[1:]) == [0] * (docs - 1)


def test_families_beside_others_in_a_leaf(spark):
    word = lambda i: "".join(chr(97 + (i * 7919 + 13) // 26**k % 26) for k in range(4))
    family = [f"This article was written by {word(i)} for our readers" for i in range(20)]
    second = [f"This article was taken from {word(i + 50)} with kind permission" for i in range(20)]
    others = [f"This article was {' '.join(word(i * 6 + k + 100) for k in range(6))}" for i in range(45)]
    assert n_dropped(spark, family + second + others) == [0] + [1] * 19 + [0] + [1] * 19 + [0] * 45


def test_short_lines_that_chance_makes_stay_in_any_corpus(spark):
    """Ordinary sentences of few words recur as the corpus grows, lines that always say the same go."""
    for size in (90, 900):
        chance = random.Random(size)
        words = ["rain", "fell", "slowly", "again"]
        unique = ["".join(chr(97 + int(c)) for c in str(i)) for i in range(size)]
        texts = [f"{u}\n{chance.choice(words)} {chance.choice(words)}" for u in unique]
        marked = [f"{t}\nRights reserved" if i % 8 == 0 else t for i, t in enumerate(texts)]
        assert n_dropped(spark, marked) == [int(size == 900 and 0 < i and i % 8 == 0) for i in range(size)]
