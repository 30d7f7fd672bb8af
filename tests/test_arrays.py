"""Array files cut anywhere against a reader of the whole text; row numbers against the order of the input."""

import json

import pyarrow as pa
import pyarrow.parquet
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.schema import RECORD_COLUMNS
from gleanery.sources import arrays
from gleanery.sources.records import read_records

strings = st.text(st.sampled_from('ab{}[],:"\\ \n é☃𝒳'), max_size=9)
values = st.recursive(strings | st.none() | st.integers() | st.booleans(), lambda v: st.lists(v, max_size=3) | st.dictionaries(strings, v, max_size=3), max_leaves=6)
objects = st.lists(st.dictionaries(strings, values, max_size=4), max_size=6)


def cut_text(text, cuts):
    """What the ranges between ``cuts`` (numbers of lines) yield, put together."""
    lines = text.encode().split(b"}")
    if lines[-1] == b"":
        lines.pop()
    bounds = [0, *sorted(min(c, len(lines)) for c in cuts), len(lines)]
    ranges = [lines[a:b] for a, b in zip(bounds, bounds[1:], strict=False) if b > a]
    inside = depth = 0
    found, held = [], ""
    for lines in ranges:
        batch = pa.RecordBatch.from_pydict(
            {"_file": ["f"] * len(lines), "_part": [0] * len(lines), "in_string": [inside] * len(lines), "depth": [depth] * len(lines), "line": lines}
        )
        (change,) = pa.Table.from_batches(arrays._changes([batch.select(["_file", "_part", "line"])])).to_pylist()
        for row in pa.Table.from_batches(arrays._cut_batches([batch])).to_pylist():
            assert not row["wrong"]
            held += row["text"] or ""
            if row["piece"] == arrays.WHOLE or (row["piece"] == arrays.GOES_ON and held and _complete(held)):
                found.append(held)
                held = ""
        depth += change["inside"] if inside else change["outside"]
        inside ^= change["odd"]
    assert not held and (inside, depth) == (0, -1)
    return found


def _complete(text):
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


@settings(max_examples=300, deadline=None)
@given(objects, st.lists(st.integers(0, 30), max_size=8), st.sampled_from([None, 1]), st.booleans())
def test_any_cuts(rows, cuts, indent, ascii_only):
    text = " \n" + json.dumps(rows, indent=indent, ensure_ascii=ascii_only) + "\n"
    assert [json.loads(t) for t in cut_text(text, cuts)] == rows


def test_small_chunks(monkeypatch):
    monkeypatch.setattr(arrays, "_CHUNK", 10)
    rows = [{"a": "}" * i, "b": {"c": [{}, {"d": "]\\"}]}} for i in range(9)]
    assert [json.loads(t) for t in cut_text(json.dumps(rows), [3, 4, 11, 40])] == rows


@pytest.fixture
def small_ranges(spark):
    """Files are cut every ``size`` bytes."""

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def record(i):
    return dict.fromkeys(RECORD_COLUMNS, "x") | {"question": f'{i} "}}],[{{" \\ é☃' * (i % 4), "answer": f"a{i}", "value": None if i % 3 else i, "more": {"n": [i, {}]}}


@pytest.mark.parametrize("size", [900, 5_000, 1 << 20])
def test_one_file_over_many_tasks(spark, tmp_path, small_ranges, size):
    rows = [record(i) for i in range(150)] + [record(1) | {"question": "long " * 3_000}]
    (tmp_path / "b.json").write_text(json.dumps(rows, ensure_ascii=False))
    (tmp_path / "a.json").write_text(json.dumps(rows[:7], indent=2))
    (tmp_path / "c.json").write_text(" [ ] ")
    small_ranges(size)
    if size == 900:
        assert arrays._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    got = [r.asDict() for r in read_records(spark, str(tmp_path)).orderBy("record_id").collect()]
    want = [{"record_id": i} | {c: None if r[c] is None else str(r[c]) for c in RECORD_COLUMNS} for i, r in enumerate(rows[:7] + rows)]
    assert [{c: r[c] for c in w} for r, w in zip(got, want, strict=True)] == want
    first = read_records(spark, str(tmp_path), limit=10).orderBy("record_id").collect()
    assert [r.answer for r in first] == [w["answer"] for w in want[:10]]


@pytest.mark.parametrize(
    "text",
    [
        '[{"a": 1}', '{"a": 1}]', '{"a": 1}', '[{"a": 1}]]', '[{"a": 1} {"b": 2}]', '[{"a": 1},,{"b": 2}]', '[{"a": 1},]', '[,{"a": 1}]',
        '[{"a": 1}, 3]', '["x", {"a": 1}]', '[[{"a": 1}]]', '[{"a": 1}] [{"a": 1}]', '[{"a": "x]', '[{"a": 1}]}', "", " ", "[", "no", '[{"a" 1}]',
    ],
)
def test_what_is_no_array_of_objects(spark, tmp_path, small_ranges, text):
    path = tmp_path / "wrong.json"
    path.write_text(text)
    small_ranges(4 if len(text) % 2 else 1 << 20)
    with pytest.raises(ValueError):
        read_records(spark, str(path))


@pytest.mark.parametrize("kind", ["jsonl", "parquet"])
def test_rows_without_keys_keep_their_order(spark, tmp_path, small_ranges, kind):
    rows = [{c: f"{i}" for c in RECORD_COLUMNS} for i in range(500)]
    for name, part in (("part-2", rows[200:]), ("part-1", rows[:200])):
        if kind == "jsonl":
            (tmp_path / name).write_text("\n".join(json.dumps(r) for r in part))
        else:
            pa.parquet.write_table(pa.Table.from_pylist(part), tmp_path / name, row_group_size=30)
    numbers = {}
    for size in (700, 1 << 20):
        small_ranges(size)
        found = read_records(spark, str(tmp_path), kind).collect()
        numbers[size] = sorted((r.record_id, r.answer) for r in found)
        assert {r.answer for r in read_records(spark, str(tmp_path), kind, limit=3).collect()} == {"0", "1", "2"}
    assert numbers[700] == numbers[1 << 20] == [(i, str(i)) for i in range(500)]
