"""The pass over the texts: nothing is missed, and what is found by chance is taken out again."""

import random

import numpy as np
import pyarrow as pa
from gleanery.operators import entities, scan, substring
from gleanery.plans.entity_log import EntityLog
from gleanery.session import materialise


def kept(strings, labels=None, bits=20):
    raw, labelled = [s.encode() for s in strings], labels is not None
    sizes = np.array(sorted({len(s) for s in raw}), np.int64)
    batch = pa.RecordBatch.from_arrays([scan.packed(raw), pa.array(labels or [0] * len(raw), pa.int64())], ["string", "label"])
    tables = [np.zeros(1 << bits - 6, np.uint64) for _ in range(3)]
    for out in scan._words(sizes, bits, labelled)([batch]):
        for kind, word, held in zip(*(c.to_pylist() for c in out.columns), strict=True):
            tables[kind][word] |= np.array([held], np.int64).view(np.uint64)[0]
    return scan.Strings(bits, sizes, sorted(set(labels)) if labelled else [0], [t.view(np.uint8) for t in tables])


def test_finds_are_those_of_plain_searches(monkeypatch):
    chance = random.Random(3)
    for i in range(60):
        letters = "ab é😀" if i % 2 else "abcdefgh "
        texts = ["".join(chance.choices(letters, k=chance.choice([0, 1, 5, 30, 300]))) for _ in range(chance.randint(1, 30))]
        strings = sorted({"".join(chance.choices(letters, k=chance.choice([1, 2, 3, 4, 6, 9, 17, 40]))) for _ in range(40)} | {texts[0][1:200]} - {""})
        strings = [s for s in strings if s]
        labels = [chance.randint(1, 3) for _ in strings] if i % 3 == 0 else None
        monkeypatch.setattr(scan, "_SLICE_BYTES", chance.choice([10, 1000, 1 << 20]))
        monkeypatch.setattr(scan, "_PAIRS", chance.choice([4, 1 << 17]))
        column, found = pa.array(["before", *texts, None, "after"])[1:-1], []
        for row, part, held in scan.found_in(kept(strings, labels), column, chance.choice([3, 64, scan.WINDOW])):
            assert row == len(found) and [t.decode() for t in part] == [*texts, ""][row : row + len(part)]
            found += [{(s.decode(errors="replace"), label) for s, label in h} for h in held]
        of = dict(zip(strings, labels or [0] * len(strings), strict=True))
        expected = [{(s, of[s]) for s in strings if s in t} for t in [*texts, ""]]
        assert len(found) == len(expected) and all(e <= f for e, f in zip(expected, found, strict=True))
        assert sum(len(f - e) for e, f in zip(expected, found, strict=True)) < 3


def test_chance_finds_are_taken_out(spark, monkeypatch):
    """Tables far too small for the strings let nearly everything through; the pairs are exact all the same."""
    monkeypatch.setattr(scan, "_MOST", 6)
    monkeypatch.setattr(scan, "_FEWEST", 6)
    chance = random.Random(5)
    texts = ["".join(chance.choices("abcd ", k=40)) for _ in range(20)] + [None]
    strings = sorted({x for _ in range(60) if (x := "".join(chance.choices("abcd ", k=chance.randint(2, 5))).strip())})
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "record_id long, text string")
    listed, seen = spark.createDataFrame([(s,) for s in strings], "string string"), []
    monkeypatch.setattr(substring, "by_chance", lambda *a, f=substring.by_chance: seen.append(f(*a)) or seen[-1])
    found = sorted(map(tuple, substring.contained_strings(df, listed).collect()))
    assert seen[0].count() > 0
    assert found == sorted({(i, s) for i, t in enumerate(texts) for s in strings if t and s in t})
    ids = sorted(r[0] for r in substring.contained_strings(df, listed, ids_only=True).collect())
    assert ids == sorted({i for i, _ in found})


def test_texts_are_neither_joined_nor_shuffled(spark, monkeypatch):
    texts = materialise(spark.createDataFrame([(i, f"ship {i} near the quick fox") for i in range(9)], "record_id long, text string"))
    strings, plans = spark.createDataFrame([("quick fox",), ("hip 3",), ("ear",)], "string string"), []

    def written(df, *a):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, *a)

    monkeypatch.setattr(substring, "materialise", written)
    assert substring.contained_strings(texts, strings).count() == 19
    read = [p for p in plans if "text#" in p]
    assert len(read) == 1 and "Join" not in read[0] and "Exchange" not in read[0]


def test_entities_of_a_batch_are_counted_by_one_shuffle(spark):
    df = spark.createDataFrame([(1, "He met Ada Lovelace. Then Bob left. then"), (2, "then bob left Ada")], "record_id long, text string")
    out = entities.partial_frequencies(df)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    names = {("he", 1, 1, 0), ("ada lovelace", 1, 0, 0), ("then bob", 1, 0, 0), ("ada", 1, 0, 0)}
    assert {tuple(r) for r in out.collect()} == names | {("met", 0, 0, 1), ("left", 0, 0, 2), ("then", 0, 0, 2), ("bob", 0, 0, 1)}


def test_what_a_batch_writes(spark, tmp_path):
    """Texts are kept once, and no table is as long as their words."""
    log = EntityLog(spark, str(tmp_path / "log"), threshold=2)
    log.add(spark.createDataFrame([(i, f"near Coal {i}" + (" xosky" if i == 4 else "")) for i in range(9)], "record_id long, text string"))
    assert {p.name for p in (tmp_path / "log").iterdir()} == {"texts", "found", "counts"}
    change = log.add(spark.createDataFrame([(20, "see Osk now")], "record_id long, text string"))
    assert {r.record_id: r.rare for r in change.flipped.collect()} == {4: True, 20: True}
    assert {r.record_id for r in log.rare_ids().collect()} == {4, 20}
    assert {tuple(r) for r in log.frequencies().collect()} == {("osk", 1), ("coal", 9)}


def test_details_are_exact_and_texts_are_read_once(spark, monkeypatch):
    """Also where the tables are too small, ids repeat or are missing, and letters have more than one byte."""
    plans, seen = [], []

    def written(df, *a):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, *a)

    monkeypatch.setattr(entities, "materialise", written)
    monkeypatch.setattr(entities, "by_chance", lambda *a, f=substring.by_chance: seen.append(f(*a)) or seen[-1])
    texts = [(1, "Café Osk, OSKAR 😀 osk"), (2, None), (3, "a mast"), (3, "osk mast mast"), (None, "osk"), (4, "aaaa é"), (5, "xyz")]
    df = materialise(spark.createDataFrame(texts, "record_id long, text string"))
    listed = [("osk", 1), ("mast", 2), ("aa", 1), ("é", 3), ("oskar 😀", 2), ("never", 9)]
    freq = spark.createDataFrame(listed + [(f"{a}{b}", 1 + i % 3) for i, a in enumerate("bcdghjl") for b in "bcdghjl"], "entity string, freq long")
    for most in (6, 27):
        monkeypatch.setattr(scan, "_FEWEST", 6)
        monkeypatch.setattr(scan, "_MOST", most)
        rows = entities.rare_entity_details(df, freq).collect()
        found = sorted((r.record_id or 0, r.text_length, [(e.text, e.frequency, e.positions) for e in r.unusual_entities_found]) for r in rows)
        assert found == [
            (0, 3, []),
            (1, 21, [("osk", 1, [5, 10, 18]), ("oskar 😀", 2, [10]), ("é", 3, [3])]),
            (2, 0, []),
            (3, 6, [("mast", 2, [2]), ("osk", 1, [])]),
            (3, 13, [("mast", 2, [4, 9]), ("osk", 1, [0])]),
            (4, 6, [("aa", 1, [0, 2]), ("é", 3, [5])]),
            (5, 3, []),
        ]
        assert all(r.unusual_count == len(r.unusual_entities_found) and r.has_unusual == (r.unusual_count > 0) for r in rows)
    assert seen[0].count() > 0
    read = [p for p in plans if "text#" in p and "MapInArrow" in p]
    assert len(read) == 2 and all("Join" not in p and "Exchange" not in p for p in read)
    assert not any("lower(" in p and p not in read for p in plans)
