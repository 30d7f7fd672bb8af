import pytest
from pyspark.sql import functions as F

from gleanery.functions.names import lower_words, mentions
from gleanery.operators import entities as E
from gleanery.operators.detectors import EntityDetector

# Log lines: ships and places as names, ordinary words at the beginning of sentences, names inside others.
ROWS = [
    "Fog lifted. The Kestrel left Marrow Point at dawn.",
    "Kestrel took on coal. Coal was dear, and fog came back.",
    "Nets were torn near Osk. Divers from Lundy Sound mended nets.",
    "Marrow Point answered; kestrelling gulls circled the mast.",
    "Fog again. Captain Ada Brisk sent for divers.",
    "",
    "all quiet, no ships. Quiet night.",
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(enumerate(ROWS)), "record_id long, text string")


def test_mentions(apply):
    text = "The Red Wharf's lamp. Olm' iBuoy 5Mast in Low Head-Bay! T-Beam N.E. D’Arcy"
    out = [(m.mention, m.initial) for m in apply(mentions, [text])[0]]
    assert out == [
        ("The Red Wharf", False), ("Olm", True), ("Low Head-Bay", False), ("T-Beam", True), ("D’Arcy", True),
    ]
    assert apply(mentions, [None, "no names"]) == [[], []]
    assert len(apply(mentions, ["Aa " * 30000])[0]) == 1  # no recursion over long runs


def test_lower_words(apply):
    assert apply(lower_words, ["The the cat’s 2nd the"]) == [["the", "cat’s"]]


def test_frequencies(table):
    found = {(r.mention, r.dropped) for r in E.entity_mentions(table).collect()}
    assert {("Coal", True), ("Nets", True), ("Divers", True), ("Kestrel", False), ("The Kestrel", False), ("Marrow Point", False)} <= found
    freq = {r.entity: r.freq for r in E.entity_frequencies(table).collect()}
    assert freq == {"kestrel": 1, "the kestrel": 1, "marrow point": 2, "osk": 1, "lundy sound": 1, "captain ada brisk": 1}
    assert freq == {r.entity: r.freq for r in E.frequencies_of(E.entity_mentions(table)).collect()}


def test_gazetteer(spark, table):
    listed = spark.createDataFrame([("osk", "GPE"), ("kestrel", "DATE"), ("osk", "GPE")], "entity string, label string")
    assert [r.entity for r in E.entity_mentions(table, gazetteer=listed).collect()] == ["osk"]


def counted(spark, rows):
    return spark.createDataFrame(rows, "entity string, freq long")


def test_rare_details(spark):
    freq = counted(spark, [("osk", 1), ("lundy sound", 1), ("kestrel", 3), ("mast", 2)])
    text = "Osk, oskar; a mast at Lundy Sound. kestrel osk"
    df = spark.createDataFrame([(1, text), (2, "nothing"), (3, None)], "record_id long, text string")
    rows = {r.record_id: r for r in E.rare_entity_details(df, freq, threshold=2).collect()}
    found = {e.text: (e.frequency, e.positions) for e in rows[1].unusual_entities_found}
    assert found == {"osk": (1, [0, 5, 43]), "lundy sound": (1, [22]), "mast": (2, [14])}
    assert rows[1].has_unusual and rows[1].unusual_count == 3 and rows[1].text_length == len(text)
    assert not rows[2].has_unusual and rows[3].text_length == 0


def test_two_phases_equal_the_nested_loop(spark, table):
    more = [(100 + i, t) for i, t in enumerate(["unosked", "xlundy soundly", "marrow pointers", "o sk", "", None, "İzmir Osk"])]
    df = table.union(spark.createDataFrame(more, "record_id long, text string"))
    freq = E.entity_frequencies(df)
    rare = [r.entity for r in E.rare_entities(freq).collect()]
    lowered = df.select("record_id", F.lower("text").alias("t")).collect()
    expected = sorted(r.record_id for r in lowered if r.t and any(e in r.t for e in rare))
    assert sorted(r.record_id for r in E.rare_entity_ids(df, freq).collect()) == expected
    assert {100, 101, 102, 106} <= set(expected) and 103 not in expected


def test_corpus_without_names(spark):
    df = spark.createDataFrame([(1, "no names here"), (2, None)], "record_id long, text string")
    assert E.rare_entity_ids(df, E.entity_frequencies(df)).count() == 0


def test_totals_and_bands(spark):
    freq = counted(spark, [("a", 1), ("b", 1), ("c", 2), ("d", 3), ("e", 4), ("f", 10), ("g", 11), ("h", 500)])
    bands = {r.band: (r.entities, r.percentage) for r in E.frequency_bands(freq).collect()}
    assert bands == {"very_rare": (2, 25.0), "rare": (2, 25.0), "uncommon": (2, 25.0), "common": (2, 25.0)}
    totals = E.frequency_totals(freq).first()
    assert (totals.total_unique_entities, totals.unusual_entities_count, totals.unusual_pct) == (8, 4, 50.0)
    assert E.frequency_totals(freq.limit(0)).first().unusual_pct is None
    assert [r.entity for r in E.top_entities(freq, 2).collect()] == ["h", "g"]
    assert [r.entity for r in E.rare_sample(freq, 3, 3).collect()] == ["a", "b", "c"]
    assert sorted(r.entity for r in E.band_examples(freq, 1).collect()) == ["a", "c", "e", "g"]


def test_model_mentions(spark, table):
    def load():
        return lambda text: [(w.strip("."), "GPE" if w.startswith("O") else "DATE") for w in text.split() if w[0] in "OL"]

    out = E.model_mentions(table, load).collect()
    assert [(r.record_id, r.entity) for r in out] == [(2, "osk")]
    detector = EntityDetector(threshold=2, mentions=lambda df: E.model_mentions(df, load))
    assert [r.record_id for r in detector.hits(table).collect()] == [2]
    other = table.filter("record_id <> 2")
    assert detector.hits(other).count() == 0  # every corpus is counted by itself
    assert [r.record_id for r in detector.fit(table).hits(table.filter("record_id < 3")).collect()] == [2]
