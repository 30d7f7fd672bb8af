"""Token ids of documents in patched frame-of-reference blocks.

Texts are sorted by id in ranges, one range per task, tokenised there and packed
into segments of whole documents. A segment is a row of a Parquet table, so that Spark's
committer handles lost and repeated tasks in any file system: shard, segment, token offset
in the shard, document ids, and two packed arrays (see ``pfor``), the documents' lengths and their ids.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm import pfor
from gleanery.llm.common import slices

END = 0  # the id behind every document
SEGMENT_TOKENS = 1 << 18
SEGMENTS = "shard int, segment int, start_in_shard long, n_tokens long, doc_ids array<long>, lengths binary, ids binary"

_SLICE_BYTES = 3 << 20
_CACHED_UNITS = 800_000
_PLAIN_UNIT = re.compile(r"\S+")
_JOINED = 64
_UNIT_BREAK = re.compile(r"(?<=\S) ")
# White space besides the blank and the line feed.
_RARE_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _units(text: str) -> list[str]:
    """Cut a text at spaces that follow another character than white space; these spaces are left out.

    Byte-level BPE starts a new word at such a place, so the ids of the parts, each but the first
    with its space in front, are those of the text.
    """
    parts = text.split(" ")
    if "" in parts or "\n " in text or _RARE_SPACE.search(text):
        return _UNIT_BREAK.split(text)
    return parts


class Encoder:
    """Ids of texts; units that were seen before are looked up.

    The cache holds a bounded number of units; others are encoded again for each slice.
    """

    def __init__(self, path: str, specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units and the length of each."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.array(list(chain.from_iterable(found)), np.uint32), lengths

    def _encode_plain(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for units of one word, many at a time with line feeds between, which stay tokens of their own."""
        lines = [" " + "\n ".join(units[i : i + _JOINED]) + "\n" for i in range(0, len(units), _JOINED)]
        flat, _ = self._encode(lines)
        breaks = np.flatnonzero(flat == self.line_feed)
        return np.delete(flat, breaks), np.diff(breaks, prepend=-1) - 1

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of one or more texts, with the end ids, and the length of each document."""
        split = [_units(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        heads = [s.pop(0) for s in split]  # without a space in front: not kept
        units = list(chain.from_iterable(split))
        places = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        unknown = np.flatnonzero(places < 0)
        names = [units[i] for i in unknown.tolist()]
        new = dict.fromkeys(names)
        plain, odd = [], []
        for u in new:
            (plain if _PLAIN_UNIT.fullmatch(u) else odd).append(u)
        missing = plain + odd
        (plain_ids, plain_lengths), (other_ids, other_lengths) = self._encode_plain(plain), self._encode([*(" " + u for u in odd), *heads])
        ids = np.concatenate([self.ids, plain_ids, other_ids])
        starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([plain_lengths, other_lengths]))])
        known = len(self.starts) - 1
        new.update(zip(missing, range(known, known + len(missing)), strict=True))
        places[unknown] = np.fromiter(map(new.__getitem__, names), np.int64, len(names))
        closing = np.cumsum(sizes)
        head = known + len(missing) + np.arange(len(texts))
        places = np.insert(places, closing - sizes - np.arange(len(texts)), head)
        room = min(_CACHED_UNITS - known, len(missing))
        if room > 0:
            self.known.update(zip(missing[:room], range(known, known + room), strict=True))
            self.ids, self.starts = ids[: starts[known + room]].copy(), starts[: known + room + 1].copy()
        # a unit of its own, with the end id, closes each document
        end = len(starts) - 1
        ids, starts = np.append(ids, np.uint32(END)), np.append(starts, starts[-1] + 1)
        order = np.insert(places, closing, end)
        lengths = starts[order + 1] - starts[order]
        stops = np.cumsum(lengths)
        values = ids[np.arange(int(stops[-1])) + np.repeat(starts[order] - (stops - lengths), lengths)]
        return values, np.diff(stops[closing + np.arange(len(texts))], prepend=0)


@functools.lru_cache(maxsize=1)
def _encoder(path: str, specials: bool) -> Encoder:
    """One encoder for all tasks that a Python worker runs: ids do not depend on what it has seen."""
    return Encoder(path, specials)


def _segment_batches(path: str, specials: bool):
    schema = pa.schema(
        [("shard", pa.int32()), ("segment", pa.int32()), ("start_in_shard", pa.int64()), ("n_tokens", pa.int64())]
        + [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = _encoder(path, specials), TaskContext.get().partitionId()
        segment = start = held = 0
        docs, lengths, ids = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal segment, start, held, docs, lengths, ids
            row = [shard, segment, start, held, docs, pfor.encode(np.concatenate(lengths)), pfor.encode(np.concatenate(ids))]
            segment, start, held, docs, lengths, ids = segment + 1, start + held, 0, [], [], []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in slices(batches, "text", _SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            values, sizes = encode(texts)
            docs += batch.column("doc_id").to_pylist()
            lengths.append(sizes)
            ids.append(values)
            held += len(values)
            if held >= SEGMENT_TOKENS:
                yield close()
        if docs:
            yield close()

    return run


def encode_segments(docs: DataFrame, tokenizer: str, specials: bool = False) -> DataFrame:
    """Segments of the token ids of ``docs`` (doc_id, text) in ascending order of id, then text.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, the same on
    all executors. With ``specials`` a special token's string inside a text is that token, as the library reads
    it; without, it is ordinary text, which no document can abuse. A null text is empty and has the end id only; null ids come
    first; repeated rows are documents of their own. Write the result before it is used.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(_segment_batches(tokenizer, specials), SEGMENTS)


def _document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths, ids = pfor.decode(row["lengths"]).astype(np.int64), pfor.decode(row["ids"]).astype("<u4")
            stops = np.cumsum(lengths)
            starts = stops - lengths
            checks = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
            columns = [
                pa.array([row["shard"]] * len(lengths), pa.int32()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(starts + row["start_in_shard"], pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(checks, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(segments: DataFrame) -> DataFrame:
    """Per document of written segments: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The offsets of shards are summed in one task: a row per task that wrote.
    """
    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    read = segments.mapInArrow(_document_batches, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return read.join(offsets, "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
