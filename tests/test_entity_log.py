"""Batch by batch against all records at once."""

import random

import pytest

from gleanery.operators import entities as E
from gleanery.plans.entity_log import EntityLog

SCHEMA = "record_id long, text string"
NAMES = ["Osk", "Lundy Sound", "Ada Brisk", "The Kestrel", "Marrow Point", "Coal", "Fog"]
WORDS = ["fog", "coal", "kestrelling", "xosky", "near", "lundy", "sound", "marrow", "pointers", "the"]


def corpus(seed, n):
    chance = random.Random(seed)
    rows = []
    for i in range(n):
        said = []
        for _ in range(chance.randint(0, 4)):
            words = [chance.choice(NAMES)] if chance.random() < 0.4 else []
            said.append(" ".join([*words, *chance.choices(WORDS, k=chance.randint(1, 3)), *([chance.choice(NAMES)] if chance.random() < 0.3 else [])]))
        rows.append((i, None if i == 3 else ". ".join(said)))
    return rows


def at_once(spark, rows, threshold):
    df = spark.createDataFrame(rows, SCHEMA)
    freq = E.entity_frequencies(df)
    return {r.entity: r.freq for r in freq.collect()}, {r.record_id for r in E.rare_entity_ids(df, freq, threshold).collect()}


def test_batches_equal_the_whole(spark, tmp_path):
    seed, sizes = 2, [8, 0, 1, 7]
    rows = corpus(seed, sum(sizes))
    random.Random(seed).shuffle(rows)
    log, done, verdicts, was = EntityLog(spark, str(tmp_path / "log"), threshold=2), [], set(), set()
    for size in sizes:
        batch = rows[len(done) : len(done) + size]
        change = log.add(spark.createDataFrame(batch, SCHEMA))
        done += batch
        freq, ids = at_once(spark, done, 2)
        assert {r.entity: r.freq for r in log.frequencies().collect()} == freq
        assert {r.record_id for r in log.rare_ids().collect()} == ids
        rare = {e for e, n in freq.items() if n <= 2}
        assert {r.entity for r in change.entered.collect()} == rare - was
        assert {r.entity for r in change.left.collect()} == was - rare
        flipped = {r.record_id: r.rare for r in change.flipped.collect()}
        assert flipped == {i: i in ids for i in ids ^ verdicts}
        verdicts, was = ids, rare
        log = EntityLog(spark, str(tmp_path / "log"), threshold=2)  # as another session finds it
    assert log.batches == len(sizes)


def test_a_broken_batch_is_done_again(spark, tmp_path, monkeypatch):
    rows = corpus(4, 9)
    log = EntityLog(spark, str(tmp_path / "log"))
    log.add(spark.createDataFrame(rows[:5], SCHEMA))
    write = EntityLog._write

    def lost(self, df, table, batch):
        if table == "found":
            raise RuntimeError("lost")
        return write(self, df, table, batch)

    monkeypatch.setattr(EntityLog, "_write", lost)
    with pytest.raises(RuntimeError):
        log.add(spark.createDataFrame([(99, "Nowhere Else")], SCHEMA))
    monkeypatch.undo()
    log = EntityLog(spark, str(tmp_path / "log"))
    log.add(spark.createDataFrame(rows[5:], SCHEMA))
    freq, ids = at_once(spark, rows, 3)
    assert {r.entity: r.freq for r in log.frequencies().collect()} == freq
    assert {r.record_id for r in log.rare_ids().collect()} == ids
