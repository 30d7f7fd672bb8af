"""Buckets against all choices of boundaries; batches against their budget."""

import itertools
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import packing


def padding(histogram, ends):
    return sum(n * (min(e for e in ends if e >= length) - length) for length, n in histogram.items())


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
def test_no_choice_pads_less(histogram, buckets):
    ends = packing.optimal_buckets(histogram, buckets)
    assert len(ends) <= buckets and ends == sorted(set(ends))
    lengths = sorted(histogram)
    choices = (c for k in range(buckets) for c in itertools.combinations(lengths[:-1], min(k, len(lengths) - 1)))
    assert padding(histogram, ends) == min(padding(histogram, [*c, lengths[-1]]) for c in choices)


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTS", 7)
    rows = [(i, "w " * (i * 7 % 60), "x") for i in range(500)]
    rows += [(500, None, "x"), (501, "", "x"), (None, "a b", "x"), (3, "same", "x"), (3, "same", "x"), (502, "long " * 10_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string")
    found = packing.pack(docs, context=50, buckets=4, budget=200).collect()
    tokens = Counter()
    for r in rows:
        tokens[r[0]] += len((r[1] or "").split())
    got = Counter()
    for r in found:
        got[r.doc_id] += r.n_tokens
        assert r.start == 50 * r.chunk and r.n_tokens <= r.bucket
    assert got == tokens and len(found) == sum(max(1, -(-len((r[1] or "").split()) // 50)) for r in rows)
    batches = defaultdict(list)
    for r in found:
        batches[r.bucket, r.batch].append(r.slot)
    last = {}
    for bucket, batch in batches:
        last[bucket] = max(last.get(bucket, 0), batch)
    for (bucket, batch), slots in batches.items():
        room = max(1, 200 // max(bucket, 1))
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) == room or (batch == last[bucket] and len(slots) < room)
    assert sorted({r.bucket for r in found}) == packing.optimal_buckets(Counter(r.n_tokens for r in found), 4)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
