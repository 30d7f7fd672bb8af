"""Cheapest edits against all edits; the tree of audits against plain strings; repaired turns against the audit."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import audit
from gleanery.llm import conversation_repair as cr

PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(initials, faults):
    """Every sequence of edits, cheapest and then first by its letters."""
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, edits, i, said = state = heapq.heappop(heap)
        if state in seen:
            continue
        seen.add(state)
        if i == len(initials) and PATTERN.fullmatch(said):
            return cost, edits
        if len(said) <= len(initials) + 2:
            for r in "ua":
                heapq.heappush(heap, (cost + 3, edits + "I", i, said + r))
        if i < len(initials):
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, said))
            if faults[i] not in "bd":
                open_end = 3 * (faults[i] == "t")
                heapq.heappush(heap, (cost + open_end, edits + "K", i + 1, said + initials[i]))
                for r in "ua":
                    heapq.heappush(heap, (cost + 3 + open_end, edits + "R", i + 1, said + r))


coded = st.lists(st.tuples(st.sampled_from("suao"), st.sampled_from("kktbd")), max_size=5)


@settings(max_examples=200, deadline=None)
@given(coded, st.lists(st.integers(0, 5), max_size=3))
def test_joined_stretches_are_cheapest(turns, cuts):
    initials, faults = "".join(i for i, _ in turns), "".join(f for _, f in turns)
    bounds = [0, *sorted(min(c, len(turns)) for c in cuts), len(turns)]
    parts = [(initials[a:b], faults[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert audit.join([lambda entry, p=p: audit.paths(*p, entry) for p in parts]) == cheapest(initials, faults)


@pytest.mark.parametrize("prime", [audit._PRIME, 7, 1])  # with few or one hash value all prefixes seem equal
def test_strings_compare_as_strings(prime):
    tree, chance = audit.Audits(prime=prime), random.Random(3)
    nodes = {audit.ROOT: ""}
    for _ in range(400):
        node = chance.choice(list(nodes))
        letters = "".join(chance.choice("DIKR") for _ in range(chance.choice([1, 1, 2, 40])))
        nodes[tree.extend(node, letters)] = nodes[node] + letters
    for a, text in nodes.items():
        assert tree.text(a) == text
        for b in chance.sample(list(nodes), 25):
            assert tree.less(a, b) == (text < nodes[b])


ROWS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 4, "user", "Hi."),
    (2, 0, "system", "Be kind."), (2, 1, "assistant", "I am"), (2, None, "user", None),
    (None, 3, "tool", "x."), (None, 3, "tool", "x."), (None, 2, "user", "Who?"),
    (3, 0, None, "Alone."), (3, 300, "user", "Far!"), (3, 900, "assistant", "Off."), (3, 901, "assistant", " \n"),
]


def plain(rows):
    """The whole operator on lists."""
    found = {}
    for conv in {r[0] for r in rows}:
        said = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        initials, faults, seen = "", "", set()
        for _, role, text in said:
            bare = text.strip(" \t\n\x0b\x0c\r")
            initials += role[:1] if role[:1] in ("s", "u", "a") else "o"
            faults += "b" if not bare else "d" if (role, text) in seen else "k" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
        numbers = {t for t, _, _ in said if t is not None}
        cost, edits = audit.join([lambda e, i=initials, f=faults: audit.paths(i, f, e)])
        rest, out = list(said), []
        for e in edits:
            _, role, text = (None, "", "") if e == "I" else rest.pop(0)
            if e != "D":
                spoken = "assistant" if out and out[-1][0][:1] == "u" else "user"
                out.append((role if e == "K" else spoken, text, e))
        counts = [faults.count(f) for f in "bdt"]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in out).encode()).hexdigest()
        found[conv] = ((gaps, *counts, illegal, cost, edits, digest), out)
    return found


@pytest.mark.parametrize("stretch", [256, 2])
def test_against_lists(spark, monkeypatch, stretch):
    monkeypatch.setattr(cr, "STRETCH", stretch)
    monkeypatch.setattr(cr, "_SLICE_BYTES", 50)
    chance = random.Random(5)
    rows = ROWS + [
        (10 + i, t, chance.choice(["user", "assistant", "assistant", "system", "", None]), chance.choice(["Oh.", "Ah!", "and", "", "é?"]))
        for i in range(40)
        for t in range(chance.randint(1, 14))
    ]
    want = plain(rows)
    # further columns do not matter, not even by the operator's own names
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, edits string, position int").repartition(5)
    got = {r.conv.conv_id: tuple(r)[1:] for r in cr.digests(turns).collect()}
    assert got == {c: w[0] for c, w in want.items()}
    said = {}
    for r in cr.repaired(turns, cr.audits(turns)).collect():
        said.setdefault(r.conv.conv_id, []).append((r.position, r.role, r.text, r.edit))
    for conv, (_, out) in want.items():
        assert [r[1:] for r in sorted(said.get(conv, []))] == out
        assert PATTERN.fullmatch("".join(role[:1] for role, _, _ in out))


def test_damage(spark):
    rows = [(c, t, "assistant", f"No. {t}! Why?") for c in range(30) for t in range(6)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        deal = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if deal:
            said = "" if deal == 1 else re.sub("[.!?]", "", text) if deal == 2 else text
            want += [(c, t, "user" if deal == 4 else role, said)] * (2 if deal == 3 else 1)
    got = cr.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_table_and_long_conversation(spark):
    empty = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert cr.digests(empty).collect() == []
    long = [("a", t, "user" if t % 2 == 0 or t % 97 == 0 else "assistant", f"w{t} " * (1 if t != 50 else 100_000) + ".") for t in range(3000)]
    (row,) = cr.digests(spark.createDataFrame(long, empty.schema)).collect()
    want = plain([tuple(r) for r in long])["a"][0]
    assert tuple(row)[1:] == want and want[5] > 0
