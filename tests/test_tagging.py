"""Labels against all labellings of short sentences, counts against Python's, spans against their texts."""

import itertools
import math
import random
from collections import Counter

import pytest

from gleanery.operators import tagging as T

SENTENCES = [
    [("Ada", "PERSON"), ("Brisk", "PERSON"), ("left", "O"), ("Osk", "GPE"), (".", "O")],
    [("The", "O"), ("Kestrel", "PRODUCT"), ("left", "O"), ("Lundy", "GPE"), (".", "O")],
    [("Ada", "PERSON"), ("sang", "O"), ("in", "O"), ("Osk", "GPE"), (".", "O")],
    [("Tomas", "PERSON"), ("sang", "O"), ("to", "O"), ("Ada", "PERSON"), (".", "O")],
    [("in", "O"), ("1920", "O"), ("the", "O"), ("Kestrel", "PRODUCT"), ("sank", "O"), (".", "O")],
]
LABELLED = "sentence array<struct<word:string,label:string>>"


@pytest.fixture(scope="module")
def tagger(spark):
    return T.fit(spark.createDataFrame([(s,) for s in SENTENCES], LABELLED))


def shape(word, opens):
    if word[0].isnumeric():
        return "<digits>"
    if word[0].isupper():
        return "<capitals>" if any(c.isupper() for c in word[1:]) else "<opening>" if opens else "<name>"
    return "<word>" if word[0].isalpha() else "<sign>"


def plain_costs():
    """First, following and word costs by counting in Python."""
    rows = [(w, shape(w, i == 0), t, s[i - 1][1] if i else None) for s in SENTENCES for i, (w, t) in enumerate(s)]
    labels = sorted({r[2] for r in rows})
    seen, pairs = Counter(r[0] for r in rows), Counter((r[3], r[2]) for r in rows)
    words = Counter((r[0] if seen[r[0]] >= 2 else r[1], r[2]) for r in rows)
    size = len({w for w, _ in words}) + 1
    total = Counter(r[2] for r in rows)

    def cost(n, of):
        return math.floor(-1000 * math.log(n / of))

    def after(b):
        return [cost(pairs[b, t] + 1, sum(pairs[b, u] for u in labels) + len(labels)) for t in labels]

    before = [after(b) for b in labels]
    emitted = {w: [cost(words[w, t] + 0.1, total[t] + 0.1 * size) for t in labels] for w, _ in [*words, ("", "")]}
    return labels, after(None), [list(c) for c in zip(*before, strict=True)], emitted


def test_counts(tagger):
    labels, first, following, words = plain_costs()
    assert (tagger.labels, tagger.first, tagger.following) == (labels, first, following)
    assert {r.word: r.costs for r in tagger.words.collect()} | {"": tagger.unseen} == words


def cheapest(words):
    labels, first, following, known = plain_costs()
    costs = [known.get(w, known.get(shape(w, i == 0), known[""])) for i, w in enumerate(words)]
    n = range(len(labels))

    def total(path):
        moves = sum(following[b][a] for a, b in itertools.pairwise(path))
        return first[path[0]] + moves + sum(c[j] for c, j in zip(costs, path, strict=True)), path

    return "".join("abcdefg"[j] for j in min(map(total, itertools.product(n, repeat=len(words))))[1])


def test_decoding_equals_all_labellings(spark, tagger):
    chance = random.Random(2)
    pool = ["Ada", "Osk", "left", "in", "The", "Kestrel", "sang", "Zorn", "x7", "1800", "NATO", ";", "Brisk"]
    texts = [" ".join(chance.choice(pool) for _ in range(chance.randint(1, 6))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "record_id long, text string").repartition(3)
    found = {r.record_id: r for r in T.label_words(df, tagger).collect()}
    for i, text in enumerate(texts):
        assert [w.text for w in found[i].words] == text.split()
        assert found[i].labels == cheapest(text.split())


def test_mentions(spark, tagger):
    """Runs of one label, but for that of words outside, with the offsets of their text."""
    text = "Ada Brisk  sang. The Kestrel left Osk\nAda sang in Lundy, in 1920 !"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, " \t ")], "record_id long, text string")
    want = []
    for sentence in ("Ada Brisk sang .", "The Kestrel left Osk \n", "Ada sang in Lundy , in 1920 !"):
        words = sentence.split(" ")
        labels = [plain_costs()[0]["abcdefg".index(c)] for c in cheapest(words)]
        for label, run in itertools.groupby(zip(labels, words, strict=True), lambda r: r[0]):
            want += [(label, " ".join(w for _, w in run))] if label != "O" else []
    out = sorted(T.entity_mentions(df, tagger).collect(), key=lambda r: r.start)
    assert {r.record_id for r in out} == {1} and [(r.label, r.mention) for r in out] == want
    assert ("PERSON", "Ada Brisk") in want and ("PRODUCT", "Kestrel") in want and ("GPE", "Lundy") in want
    assert all("".join(text[r.start : r.end].split()) == "".join(r.mention.split()) and r.entity == r.mention.lower() and not r.dropped for r in out)


def test_long_sentences_are_labelled_in_pieces(spark, tagger, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 4)
    df = spark.createDataFrame([(1, "a b c d e f. g h! " + "x " * 9)], "record_id long, text string")
    found = sorted((r.sentence, [w.text for w in r.words]) for r in T.label_words(df, tagger).collect())
    assert [w for _, w in found] == [list("abcd"), ["e", "f", "."], ["g", "h", "!"], ["x"] * 4, ["x"] * 4, ["x"]]


def test_gazetteer_marks_sentences(spark):
    listed = [("new osk", "GPE"), ("new", "ORG"), ("osk bay light", "LOC"), ("osk", "GPE"), ("ada", "PERSON"), ("ada", "ORG"), ("today", "DATE")]
    gazetteer = spark.createDataFrame(listed, "entity string, label string")
    df = spark.createDataFrame([(1, "Ada left New Osk Bay Light today. NEW day"), (2, "nothing"), (3, None)], "record_id long, text string")
    found = {(r.record_id, r.sentence_number): [(w.word, w.label) for w in r.sentence if w.label != "O"] for r in T.mark(df, gazetteer).collect()}
    assert found == {(1, 0): [("Ada", "ORG"), ("New", "GPE"), ("Osk", "GPE")], (1, 1): [("NEW", "ORG")], (2, 0): []}


def test_labels_are_bounded(spark):
    many = [([("w", f"L{i}")],) for i in range(27)]
    for rows in ([], many):
        with pytest.raises(ValueError, match="labels"):
            T.fit(spark.createDataFrame(rows, LABELLED))
