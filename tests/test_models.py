"""Learned base forms, languages by letters and clean dictionaries against plain counting."""

import itertools
import math
import random
from collections import Counter, defaultdict

import pytest

from gleanery.functions import words as W
from gleanery.operators import language, lemmas, ngrams, spelling

# ------------------------------------------------------------ base forms

NOUNS = "boat gull rope tide harbour mast berry fly baby bus box wish dish lily cry pony kiss net dog cat hat pen".split()
VERBS = "sail carry bake love plan stop tip wade haul hope dry try rub beg pin smile dance walk row".split()
VOWELS = "aeiou"


def inflect(word, verb):
    last, before = word[-1], word[-2]
    doubled = word + last if verb and last in "bgmnpt" and before in VOWELS and word[-3] not in VOWELS else word
    stem = word[:-1] if last == "e" else doubled
    plural = word[:-1] + "ies" if last == "y" and before not in VOWELS else word + "es" if last in "sxz" or word[-2:] in ("sh", "ch") else word + "s"
    past = word[:-1] + "ied" if last == "y" else stem + "ed"
    return [word, plural, *([stem + "ing", past] if verb else [])]


def pairs():
    return [(f, w) for verb, ws in ((False, NOUNS), (True, VERBS)) for w in ws for f in inflect(w, verb)] + [("went", "go"), ("geese", "goose")]


def plain_rules(pairs):
    votes = defaultdict(Counter)
    for form, lemma in set(pairs):
        kept = len([1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(form, lemma, strict=False))])
        cut, edged = len(form) - kept, "^" + form
        for suffix in {edged[len(edged) - n :] for n in [*range(cut, min(cut + 4, len(edged)) + 1), len(edged)]}:
            votes[suffix][cut, lemma[kept:]] += 1
    rules = {}
    for suffix, found in votes.items():
        if sum(found.values()) >= 2 or suffix.startswith("^"):
            rules[suffix] = min(found, key=lambda r: (-found[r], *r))
    return rules


def plain_lemma(word, rules):
    edged = "^" + word
    for n in range(len(edged), -1, -1):
        if edged[len(edged) - n :] in rules:
            cut, ending = rules[edged[len(edged) - n :]]
            return (word[: len(word) - cut] + ending if cut <= len(word) else "") or word
    return word


def test_rules_and_lemmas(spark):
    known = [(f, w) for f, w in pairs() if hash_of(w) % 4]
    rules = lemmas.fit(spark.createDataFrame([*known, known[0], (None, "x"), ("x", None), ("", "x")], "form string, lemma string"))
    want = plain_rules(known)
    assert {r.suffix: (r.cut, r.ending) for r in rules.collect()} == want
    words = sorted({f for f, _ in pairs()} | {"", "s", "ing", "é", "unknowns", "zzies"})
    found = {r.word: r.lemma for r in lemmas.lemmas(spark.createDataFrame([(w,) for w in words], "word string"), rules).collect()}
    assert found == {w: plain_lemma(w, want) for w in words}
    assert all(found[f] == w for f, w in known if ("went" in f or "geese" in f))


def hash_of(word):
    return sum(word.encode())


def test_better_than_the_listed_endings(spark, apply):
    """On forms of words that taught nothing: the one learned lemma against the only listed candidate."""
    known = [(f, w) for f, w in pairs() if hash_of(w) % 3]
    rest = [(f, w) for f, w in pairs() if hash_of(w) % 3 == 0 and w not in ("go", "goose")]
    rules = lemmas.fit(spark.createDataFrame(known, "form string, lemma string"))
    found = {r.word: r.lemma for r in lemmas.lemmas(spark.createDataFrame([(f,) for f in sorted({f for f, _ in rest})], "word string"), rules).collect()}
    learned = sum(found[f] == w for f, w in rest)
    listed = sum(c == ([f] if f == w else [f, w]) for (f, w), c in zip(rest, apply(W.base_forms, [f for f, _ in rest]), strict=True))
    assert learned > listed and learned >= 0.7 * len(rest)


def test_no_pairs_teach_nothing(spark):
    rules = lemmas.fit(spark.createDataFrame([], "form string, lemma string"))
    words = spark.createDataFrame([("boats",), ("",)], "word string")
    assert {r.word: r.lemma for r in lemmas.lemmas(words, rules).collect()} == {"boats": "boats", "": ""}


def test_learned_lemmas_in_the_dictionary_test(spark):
    rules = lemmas.fit(spark.createDataFrame(pairs(), "form string, lemma string"))
    known = spark.createDataFrame([(w,) for w in ("go", "boat", "the", "planet")], "word string")
    df = spark.createDataFrame([(1, "the boats went"), (2, "the planing")], "record_id long, text string")
    assert [r.record_id for r in language.non_english_ids(df, language.lexicon(df, known, rules=rules)).collect()] == [2]


# ----------------------------------------------------- languages by letters

TEXTS = {
    "en": """the wind was rising when they walked down through the old town towards the harbour and nobody thought about what
      would happen with the boats which the night watch had brought in while everything else was still sleeping through the storm""",
    "fr": """le vent se levait quand nous sommes descendus vers le vieux port et personne ne pensait que les bateaux que nous avions
      ramenés pendant la nuit seraient encore là quand le soleil reviendrait au dessus des maisons blanches de cette petite ville""",
    "de": """der wind wurde stärker als wir durch die alte stadt zum hafen gingen und niemand dachte daran was mit den schiffen
      geschehen würde die man in der nacht hereingebracht hatte während alles andere noch schlief und der sturm schon über die dächer zog""",
    "es": """el viento soplaba cuando bajamos por la ciudad vieja hacia el puerto y nadie pensaba en lo que pasaría con los barcos
      que habían traído durante la noche mientras todo lo demás todavía dormía y la tormenta ya pasaba sobre los tejados rojos""",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(TEXTS.items())] + [(9, "untold", None), (10, None, "en")]
    return ngrams.fit(spark.createDataFrame(rows, "record_id long, text string, lang string"))


def plain_costs(word, lang):
    counts = Counter()
    for known in {w for w in TEXTS[lang].split()}:
        edged = f"_{known}_"
        for e in range(2, len(edged) + 1):
            for n in range(1, min(e, 3) + 1):
                counts[edged[e - n : e]] += 1
    total, edged = 0, f"_{word}_"
    for e in range(2, len(edged) + 1):
        longest = min(e, 3)
        cost = 9000
        for n in range(longest, 0, -1):
            run = edged[e - n : e]
            if counts[run]:
                of = sum(c for r, c in counts.items() if len(r) == n and r[:-1] == run[:-1])
                cost = math.floor(-1000 * math.log(counts[run] / of)) + (longest - n) * 1200
                break
        total += cost
    return total


def test_costs(spark, model):
    words = ["wind", "wanderung", "fromage", "x", "ventana", "zzzq", "ñandú"]
    found = {r.word: r.costs for r in ngrams.word_costs(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    assert model.languages == ["de", "en", "es", "fr"]
    assert found == {w: [plain_costs(w, lang) for lang in model.languages] for w in words}


def test_foreign_words_without_accents(spark, model):
    words = {"hafenstadt": "de", "schlechten": "de", "pensions": "fr", "viejos": "es", "pasados": "es", "nothing": "en", "thinking": "en", "qwrtzx": None}
    found = {r.word: r for r in ngrams.languages_of(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    for word, lang in words.items():
        assert found[word].foreign == (lang not in ("en", None)), word
        assert lang is None or found[word].language == lang


def test_letters_in_the_dictionary_test(spark, model):
    known = spark.createDataFrame([(w,) for w in set(TEXTS["en"].split())], "word string")
    df = spark.createDataFrame([(1, "the qwrtzx was rising"), (2, "the hafenstadt was old"), (3, "the wind")], "record_id long, text string")
    assert sorted(r.record_id for r in language.non_english_ids(df, language.lexicon(df, known)).collect()) == [1, 2]
    assert [r.record_id for r in language.non_english_ids(df, language.lexicon(df, known, letters=model)).collect()] == [2]


# ------------------------------------------------------- clean dictionaries


def plain_slips(counts, far_more):
    def forms(w):
        return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}

    found = {}
    for w, n in counts.items():
        beside = [(m, v) for v, m in counts.items() if len(w) >= 4 <= len(v) and m >= far_more * n and forms(w) & forms(v)]
        if beside:
            found[w] = max(beside)[1]
    return found


def test_slips(spark):
    chance = random.Random(6)
    counts = {}
    for word in ("harbour", "harbours", "boats", "boast", "sail", "mast", "most", "storm"):
        counts[word] = chance.choice([3, 40, 900])
        for _ in range(6):
            i = chance.randrange(len(word))
            counts.setdefault(word[:i] + chance.choice(["", "x", word[i] * 2, "é"]) + word[i + 1 :], chance.randint(1, 5))
    df = spark.createDataFrame(list(counts.items()), "word string, records long")
    for far_more in (2, 20):
        found = {r.word: r.meant for r in spelling.slips(df, far_more).collect()}
        assert found == plain_slips(counts, far_more) and found


def test_a_corpus_and_its_noisy_copies_have_one_dictionary(spark):
    chance = random.Random(8)
    common = ["harbour", "morning", "captain", "weather", "lantern", "anchor", "seldom", "tide"]
    texts = [" ".join(chance.sample(common, 5)) for _ in range(200)]
    copies = texts * 10
    noisy = list(copies)
    for i in chance.sample(range(len(noisy)), 120):
        words = noisy[i].split()
        j = chance.randrange(5)
        at = chance.randrange(len(words[j]))
        words[j] = words[j][:at] + chance.choice("aeiourst") + words[j][at:]
        noisy[i] = " ".join(words)

    def dictionary(rows):
        df = spark.createDataFrame(list(enumerate(rows)), "record_id long, text string")
        return {r.word for r in spelling.clean_dictionary(df, least_share=0.001).collect()}

    assert dictionary(texts) == dictionary(copies) == dictionary(noisy) == set(common)


def test_empty_corpus(spark):
    empty = spark.createDataFrame([], "record_id long, text string")
    assert spelling.clean_dictionary(empty).collect() == [] and spelling.slips(spelling.word_counts(empty)).collect() == []
