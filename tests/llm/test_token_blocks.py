"""Token blocks: exact round trips and the library's own ids."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gleanery.llm import pfor, token_blocks
from gleanery.session import materialise

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [" a  b \n c ", "", None, "\n\n x", "a\n  b   c", "x <|endoftext|> y", "  ", " ", "it's  we'll 12 a1", "\x1c a \x85 b  c", "日本 語 é"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=900), st.integers(0, 900), st.integers(0, 900))
def test_pfor_round_trip(values, start, stop):
    data = pfor.encode(np.array(values, np.uint32))
    assert pfor.decode(data).tolist() == values
    assert pfor.decode(data, start, stop).tolist() == values[start:stop]


def test_pfor_keeps_blocks_narrow_in_spite_of_outliers():
    values = np.where(np.arange(5000) % 50 == 0, 2**31, np.arange(5000) % 16).astype(np.uint32)
    assert len(pfor.encode(values)) < len(values)
    with pytest.raises(ValueError):
        pfor.decode(b"\0" * 40)


def library_ids(texts, specials=False):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = not specials
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tab,.'’s1é \x1c"), max_size=30), min_size=1, max_size=4))
def test_units_give_the_ids_of_the_whole_text(texts):
    values, lengths = token_blocks.Encoder(PATH)(texts)
    expected = library_ids(texts)
    assert lengths.tolist() == [len(x) for x in expected]
    assert values.tolist() == [i for x in expected for i in x]


def test_read_back(spark, monkeypatch):
    monkeypatch.setattr(token_blocks, "_CACHED_UNITS", 20)
    texts = [*ODD, *("word%d and more, " % (i % 7) * (i % 40) for i in range(200)), "long text. " * 40000]
    rows = [((i * 37) % 500 - 20, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (5, "same id", "x"), (5, "same id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(4)
    segments = materialise(token_blocks.encode_segments(df, PATH))
    found = [tuple(r) for r in token_blocks.read_documents(segments).collect()]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, at = [], 0
    for (doc_id, _, _), ids in zip(ordered, library_ids([t for _, t, _ in ordered]), strict=True):
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_blocks.read_documents(materialise(token_blocks.encode_segments(empty, PATH))).collect() == []
