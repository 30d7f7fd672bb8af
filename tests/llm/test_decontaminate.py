"""Benchmark passages against a plain search; the index against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import decontaminate
from gleanery.llm.fm_index import FMIndex, suffix_array

KEPT = set("0123456789abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in KEPT or c > "\x7f" else " " for c in folded).split(" ")


def plain(text, items):
    words = [w for w in plain_words(text) if w]
    hit, ids = set(), set()
    for item, said in items:
        own = [w for w in plain_words(said) if w]
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words)):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                ids.add("" if item is None else str(item))
    return len(words), sorted(ids), hit


runs = st.lists(st.lists(st.integers(1, 3), max_size=12), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(runs, st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=5), min_size=1, max_size=5), st.integers(1, 5))
def test_index_finds_all_places(parts, patterns, sample):
    seq = np.array([x for p in parts for x in (*p, 0)])
    order = suffix_array(seq)
    zeros = np.cumsum(seq == 0)
    keyed = [[int(x) + 1000 if x else int(zeros[i + k]) for k, x in enumerate(seq[i:])] for i in range(len(seq))]
    assert order.tolist() == sorted(range(len(seq)), key=keyed.__getitem__)
    grid = np.zeros((len(patterns), 5), np.int64)
    for i, p in enumerate(patterns):
        grid[i, : len(p)] = p
    index = FMIndex(seq, 4, sample)
    low, high = index.search(grid, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, low, high, strict=True):
        places = [i for i in range(len(seq)) if seq[i : i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == places


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "ß1", "日本"]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, say(r.choice([1, 2, 9, 10, 11, 25]) if i < 12 else 30)) for i in range(30)]
    items += [(None, say(12)), (3, say(12)), (99, None), (98, " -- "), (97, items[20][1])]
    rows = []
    for i in range(120):
        parts = [say(r.randrange(30))]
        for _ in range(r.choice([0, 0, 1, 3])):
            said = r.choice(items)[1] or ""
            cut = said.split(" ")
            a = r.randrange(len(cut))
            parts += [r.choice([said, said.upper(), ", ".join(cut[a : a + 14])]), say(r.randrange(9))]
        rows.append((i, "\n".join(parts)))
    rows += [(200, None), (201, ""), (202, " -!"), (None, items[25][1]), (203, "a" * 300_000), (204, say(20_000)), (5, rows[5][1]), (5, "x")]
    return rows, items


@pytest.mark.parametrize("block", [500_000, 40])
def test_against_a_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rows, items = corpus(3)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, items string").repartition(3)
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n int")
    found = [(r.doc_id, r.n_words, r.items, {q for s in r.spans for q in range(*s)}) for r in decontaminate.contamination(docs, benchmark).collect()]
    expected = [(i, *plain(t, items)) for i, t in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_cutting(spark):
    items = [(1, " ".join(f"b{i}" for i in range(12))), (2, "short one")]
    text = f"Début, {items[0][1].upper()}! then “Short, ONE” and {' '.join(items[0][1].split()[:9])} end"
    rows = [(1, text, "k"), (2, "clean", None), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    kept = decontaminate.remove_passages(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.schema == docs.schema
    # a typographic quote is beyond ASCII and so part of its word: that item does not occur
    expected = f"Début, ! then “Short, ONE” and {' '.join(items[0][1].split()[:9])} end"
    assert [tuple(r) for r in kept.orderBy("doc_id").collect()] == [(1, expected, "k"), *rows[1:]]


def test_empty_tables(spark):
    docs, benchmark = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.contamination(docs, benchmark).collect()] == [(1, 2, [], [])]
    assert decontaminate.contamination(docs.limit(0), benchmark).collect() == []
