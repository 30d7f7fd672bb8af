"""Targets against the plain rule, draws against quotas and permutations, words against the blocks, reruns against each other."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.llm import mixing
from gleanery.llm.mixing import Mix

SCHEMA = "doc_id long, source string, text string"


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by source, in order: what is above the limit is shared again until nothing is."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def documents(seed=1, n=300):
    chance = np.random.default_rng(seed)
    sources = ["b", "a", "é", "", "hot", "hot", "hot", None, "z"]
    rows = []
    for i in range(n):
        source = sources[int(chance.integers(len(sources)))]
        size = int(chance.integers(0, 80)) if i % 50 else 4000
        rows.append((i, source, " ".join(f"w{i}.{j}" for j in range(size)) + " \n"))
    rows += [(5, "z", "same words"), (5, "z", "same words"), (None, "z", "x y"), (None, None, None), (900, "only nothing", ""), (901, "tiny", "one")]
    return rows


def sizes_of(rows):
    found = Counter()
    for _, source, text in rows:
        found[source] += len((text or "").split())
    return found


@pytest.fixture(scope="module")
def mixed(spark):
    rows = documents()
    mix = Mix(spark.createDataFrame(rows, SCHEMA).repartition(7), block=16, slots=64)
    return rows, mix, mix.taken().collect()


def test_targets_and_rows(mixed):
    rows, _, taken = mixed
    sizes = sizes_of(rows)
    want = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in taken) == Counter((i, s, len((t or "").split())) for i, s, t in rows)
    for r in taken:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size


def test_taken_words_come_near_the_targets(mixed):
    rows, _, taken = mixed
    words, sizes = Counter(), sizes_of(rows)
    for r in taken:
        words[r.source] += r.taken
    for source, target in plain_targets(sizes).items():
        # half a block by rounding the quota, and the short last block of the source
        assert abs(words[source] - target) <= 1.5 * 16


def test_slots(mixed):
    _, mix, _ = mixed
    draws = mix.draws.collect()
    blocks = {r.number: -(-r.source_size // 16) for r in mix.sources.collect()}
    quota = {r.number: r.quota for r in mixing.quotas(mix.sources, 16).collect()}
    assert Counter(r.number for r in draws) == Counter(quota)
    # every slot is filled once; all shards but the last are full
    total = sum(quota.values())
    assert sorted((r.shard, r.slot) for r in draws) == [(i // 64, i % 64) for i in range(total)]
    times = Counter((r.number, r.round, r.block) for r in draws)
    assert max(times.values()) == 1 and all(r.block < blocks[r.number] for r in draws)
    for number, q in quota.items():
        for turn in range(2):
            assert len({r.block for r in draws if (r.number, r.round) == (number, turn)}) == min(max(q - turn * blocks[number], 0), blocks[number])


def test_counts_of_shards_are_as_multinomial_ones(spark):
    sources = [(i, 100_000, q, 0) for i, q in enumerate([10_000, 5_000, 4_000, 1_000])]
    below, rows = 0, []
    for number, blocks, quota, _ in sources:
        rows.append((number, blocks, quota, below))
        below += quota
    shares = spark.createDataFrame(rows, "number long, blocks long, quota long, below long")
    counts = {(r.shard, r.number): r["count"] for r in mixing.draw(shares, slots=100).groupBy("shard", "number").count().collect()}
    # chi-squared of 200 shards of 100 slots, about 200 * (4 - 1)
    found = sum((counts.get((s, n), 0) - 100 * q / 20_000) ** 2 / (100 * q / 20_000) for s in range(200) for n, _, q, _ in sources)
    assert 500 < found < 700
    # the shares of early and late shards agree: what is handed over is spread
    early = sum(counts.get((s, 0), 0) for s in range(100))
    assert abs(early - 5_000) < 200


def test_words_of_the_slots(mixed):
    rows, mix, taken = mixed
    slots = mix.texts().collect()
    found = Counter(w for r in slots for w in r.text.split(" "))
    want = Counter()
    for r in taken:
        want[r.doc_id] += r.taken
    by_doc = defaultdict(int)
    for word, n in found.items():
        if "." in word:
            by_doc[int(word[1:].split(".")[0])] += n
    assert all(by_doc[i] == want[i] for i in range(300) if i != 5)
    assert sum(found.values()) == sum(r.taken for r in taken)
    assert all(len(r.text.split(" ")) <= 16 for r in slots)
    assert Counter(len(r.text.split(" ")) for r in slots)[16] > len(slots) - 2 * 9


def test_reruns_and_partitionings_agree(spark):
    docs = spark.createDataFrame(documents(2, 120), SCHEMA)
    wide = docs.select(*docs.columns, F.lit("x").alias("number"), F.lit(1).alias("size"), F.lit(2).alias("start"))
    one = Mix(docs.coalesce(1), block=16, slots=64).taken().collect()
    two = Mix(wide.repartition(9).orderBy(F.col("doc_id").desc()), block=16, slots=64).taken().collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    other = Mix(docs, block=16, slots=64, seed=4).taken().collect()
    assert sorted(map(str, one)) != sorted(map(str, other))


@pytest.mark.parametrize("rows", [[], [(1, "a", None), (2, None, " ")]])
def test_nothing_to_mix(spark, rows):
    mix = Mix(spark.createDataFrame(rows, SCHEMA))
    assert [(r.size, r.taken, r.target) for r in mix.taken().collect()] == [(0, 0, 0.0)] * len(rows)
    assert mix.texts().collect() == []


def test_parts_of_a_large_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 10)
    rows = [(i, "hot", "w " * (i % 9)) for i in range(300)] + [(7, "hot", "again and again")] * 9000
    placed = Mix(spark.createDataFrame(rows, SCHEMA), block=16, slots=64).documents.collect()
    spans = sorted((r.start, r.start + r.size) for r in placed if r["size"])
    assert len(placed) == len(rows) and spans[0][0] == 0
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(-(2**63), 2**63 - 1))
def test_permutations(n, key):
    index = np.arange(n)
    found = mixing.permuted(index, np.full(n, n), np.full(n, key))
    assert sorted(found.tolist()) == index.tolist()


def test_permutations_of_many_sizes_at_once():
    sizes = [1, 2, 3, 4, 5, 1 << 20, (1 << 40) + 1]
    found = mixing.permuted(np.array([n - 1 for n in sizes]), np.array(sizes), np.arange(len(sizes)))
    assert all(0 <= f < n for f, n in zip(found.tolist(), sizes, strict=True))
