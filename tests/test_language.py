import random

import pytest

from gleanery.functions import words as W
from gleanery.operators import language as L
from gleanery.operators.detectors import LanguageDetector

KNOWN = """a at boil boat brass build calm carry dry gull harbour heavy is it kiss lift light love merry my nice on rope
run sail slow storm strong tide to try was water wide be big able happy""".split()

# A text, and the words in it that the rules call foreign.
CASES = [
    ("My boat is slow", []),
    ("heavier boats carried lighter ropes", []),  # endings are undone
    ("the tide is qvist", ["the", "qvist"]),
    ("Dry rope at Ostrava harbour, dry rope at Ostrava", []),  # only ever a name
    ("Zilch sails. It is zilch.", ["Zilch", "zilch"]),  # also in lower case, so no name
    ("ab xy zq on it", []),  # too short to judge
    ("yeah okay hmm gon", []),  # listed as harmless
    ("naïve tide", ["naïve"]),
    ("łódź on water", ["łódź"]),
    ("x2y boat-qvist's", ["qvist"]),  # mixed with digits is no word; a hyphen and an ending part words
    ("", []),
]


@pytest.fixture(scope="module")
def dictionary(spark):
    return L.word_list(spark.createDataFrame([(w.upper(),) for w in KNOWN], "w string"))


def test_non_ascii(apply):
    assert apply(W.has_non_ascii, ["cafe", "café", "Ā", "Ж", "ё", "×", "中", "α", None]) == [
        False, True, True, True, False, True, False, False, False,
    ]
    assert apply(W.non_ascii_chars, ["é à é", "x", None]) == [["à", "é"], [], []]


def test_alpha_words(apply):
    texts = ["Don't stop: it's 2nd rock'n'roll, well-known x_y l'eau (word) they'll can’t", "'quoted'", None]
    assert apply(W.alpha_words, texts) == [
        ["Do", "stop", "it", "well", "known", "word", "they", "ca"],
        ["quoted"],
        [],
    ]


@pytest.mark.parametrize(
    "word,form",
    [("kisses", "kiss"), ("running", "run"), ("happily", "happy"), ("nicer", "nice"), ("biggest", "big"),
     ("tried", "try"), ("loved", "love"), ("ably", "able"), ("kiss", "kiss")],
)
def test_base_forms(apply, word, form):
    assert form in apply(W.base_forms, [word])[0]


def test_base_forms_keep_short_stems(apply):
    assert apply(W.base_forms, ["is", "bed", "ciao"]) == [["is"], ["bed"], ["ciao"]]


def test_cases(spark, dictionary):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "record_id long, text string")
    lexicon = L.lexicon(df, dictionary)
    assert sorted(r.record_id for r in L.non_english_ids(df, lexicon).collect()) == [i for i, (_, w) in enumerate(CASES) if w]
    found = sorted((r.record_id, r.start, r.end, r.token) for r in L.non_english_words(df, lexicon).collect())
    assert [(i, t) for i, _, _, t in found] == [(i, w) for i, (_, ws) in enumerate(CASES) for w in ws]
    assert all(CASES[i][0][start:end] == token for i, start, end, token in found)
    details = {r.record_id: r for r in L.non_english_details(df, lexicon).collect()}
    for i, (text, words) in enumerate(CASES):
        assert [w.token for w in details[i].non_english_words] == words
        assert details[i].non_ascii_chars == sorted({c for c in text if c in "ïłóź"})


def test_lower_case_elsewhere_makes_a_common_word(spark, dictionary):
    df = spark.createDataFrame([(1, "Blorb is calm"), (2, "my blorb")], "record_id long, text string")
    assert sorted(r.record_id for r in L.non_english_ids(df, L.lexicon(df, dictionary)).collect()) == [1, 2]


def test_verdicts_of_the_corpus_hold_for_a_part(spark, dictionary):
    df = spark.createDataFrame([(1, "Blorb is calm"), (2, "my blorb")], "record_id long, text string")
    detector = LanguageDetector(dictionary).fit(df)
    assert detector.hits(df).count() == 2
    assert detector.details(df.filter("record_id = 1")).first().detected == ["Blorb"]
    assert LanguageDetector(dictionary).hits(df.filter("record_id = 1")).count() == 0


def test_one_odd_spelling_changes_nothing(spark, dictionary):
    rows = [(i, "Carry water to Odalys") for i in range(100)]
    for more in ([], [(100, "odalys")]):
        df = spark.createDataFrame(rows + more, "record_id long, text string")
        assert L.non_english_ids(df, L.lexicon(df, dictionary)).count() == 0


def test_artifacts_and_irregular_forms(spark, dictionary):
    df = spark.createDataFrame([(1, "okay hmm yeah"), (2, "it became calm")], "record_id long, text string")
    assert [r.record_id for r in L.non_english_ids(df, L.lexicon(df, dictionary)).collect()] == [2]
    irregular = spark.createDataFrame([("became", "be")], "form string, lemma string")
    assert L.non_english_ids(df, L.lexicon(df, dictionary, irregular=irregular)).count() == 0


def test_phrases(spark, dictionary):
    """Every mix of known and unknown words: the unknown ones in order, with repeats, whatever their length."""
    chance = random.Random(4)
    pool = [*KNOWN, "qv", "okay", "brix", "brix", "zél", "Tide", "RUNNING"]
    phrases = [[chance.choice(pool) for _ in range(chance.randint(0, 9))] for _ in range(60)]
    df = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(phrases)], "record_id long, text string")
    out = {r.record_id: r.non_english_words for r in L.phrase_check(df, dictionary).collect()}
    assert out == {i: [w for w in p if w in ("qv", "okay", "brix", "zél")] for i, p in enumerate(phrases)}


def test_corpus_dictionary(spark):
    df = spark.createDataFrame([(1, "The cat the cat"), (2, "a Cat")], "record_id long, text string")
    assert [r.word for r in L.corpus_dictionary(df, min_records=2).collect()] == ["cat"]
