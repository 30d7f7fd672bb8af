"""Find and cut passages of benchmark items in documents.

Every window of ten consecutive item words is a phrase; an item of fewer words is one phrase.
The documents of a task are indexed shard by shard (see ``fm_index``), all
phrases are searched in each index, and the occurrences are merged to spans of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import slices
from gleanery.llm.fm_index import FMIndex

# Words are runs of ASCII digits, lower-case letters and everything beyond ASCII.
WINDOW = 10
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c if c >= 0x80 or c in _KEPT else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_WORD = re.compile(rb"[^ ]+")

# Bounds of what is broadcast at once and of what is indexed at once. A single longer text is a shard of its own.
BLOCK_WORDS = 500_000
_SHARD_BYTES = 4 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Phrases:
    """The different phrases of a block of items, as word numbers, and the items of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        number, found = self.vocabulary, {}
        for item, words in items:
            ids = tuple(number.setdefault(w, len(number) + 1) for w in words)
            size = min(WINDOW, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                found.setdefault(ids[i : i + size], set()).add(item)
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.patterns = np.zeros((len(found), WINDOW), np.int64)
        for i, phrase in enumerate(found):
            self.patterns[i, : len(phrase)] = phrase
        self.items = [sorted(x) for x in found.values()]


def blocks_of(benchmark: DataFrame) -> list[Broadcast]:
    """Phrases of ``benchmark`` (item_id, text) in broadcast blocks of at most about ``BLOCK_WORDS`` words.

    The items stream through the driver one block at a time. A null text has no words; a null id is an empty
    one; rows of the same id are one item with the windows of each.
    """
    context = benchmark.sparkSession.sparkContext
    blocks, items, held = [], [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    for row in rows.toLocalIterator():
        words = words_of(row.text)
        items.append((row.item, words))
        held += len(words)
        if held >= BLOCK_WORDS:
            blocks.append(context.broadcast(Phrases(items)))
            items, held = [], 0
    if held:
        blocks.append(context.broadcast(Phrases(items)))
    return blocks


def _occurrences(docs: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and phrase of every occurrence in a shard.

    A word outside the vocabulary ends a run; runs shorter than the shortest phrase cannot hold an
    occurrence. The other runs are indexed.
    """
    get = phrases.vocabulary.get
    known = [np.array([get(w, 0) for w in words] + [0], np.int64) for words in docs]
    sizes = np.array([len(k) for k in known], np.int64)
    seq = np.concatenate(known)
    ends = np.flatnonzero(seq == 0)  # the last word of the shard is a 0
    starts = np.append(0, ends[:-1] + 1)
    long_ = ends - starts >= phrases.lengths.min()
    runs = ends[long_] - starts[long_] + 1
    if not len(runs):
        return (np.zeros(0, np.int64),) * 3
    places = np.arange(int(runs.sum())) + np.repeat(starts[long_] - (np.cumsum(runs) - runs), runs)
    index = FMIndex(seq[places], len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.patterns, phrases.lengths)
    counts = np.maximum(high - low, 0)
    rows = np.arange(int(counts.sum())) + np.repeat(low - (np.cumsum(counts) - counts), counts)
    at = places[index.locate(rows)]
    firsts = np.cumsum(sizes) - sizes
    doc = np.searchsorted(firsts, at, side="right") - 1
    return doc, at - firsts[doc], np.repeat(np.arange(len(counts)), counts)


def find(texts: list[str | None], blocks: list[Phrases]) -> list[tuple[int, list[str], list[tuple[int, int]]]]:
    """Per text: number of words, ids of the items that occur (sorted), merged spans of words."""
    docs = [words_of(t) for t in texts]
    items: list[set[str]] = [set() for _ in docs]
    found: list[list[tuple[int, int]]] = [[] for _ in docs]
    for phrases in blocks:
        doc, first, phrase = _occurrences(docs, phrases)
        for d, p in np.unique(np.stack([doc, phrase], axis=1), axis=0).tolist():
            items[d].update(phrases.items[p])
        order = np.lexsort((first, doc))
        last = first + phrases.lengths[phrase]
        for d, a, b in zip(doc[order].tolist(), first[order].tolist(), last[order].tolist(), strict=True):
            found[d].append((a, b))
    out = []
    for words, ids, spans in zip(docs, items, found, strict=True):
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        out.append((len(words), sorted(ids), merged))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without spans of words: from the first letter of a span to the last."""
    data = text.encode()
    words = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    parts, at = [], 0
    for a, b in spans:
        parts.append(data[at : words[a][0]])
        at = words[b - 1][1]
    return b"".join([*parts, data[at:]]).decode()


_FOUND = "doc_id long, n_words long, items array<string>, spans array<struct<start:long,end:long>>"


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, items, spans (of words, merged, end exclusive).

    Null and empty texts have no words and no items. Repeated rows are judged each, other columns are ignored. Nothing is
    shuffled; only the phrases are broadcast, in blocks of bounded size. The items are read when this is called.
    """
    blocks = blocks_of(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SHARD_BYTES):
            found = find(batch.column("text").to_pylist(), [b.value for b in blocks])
            spans = [[{"start": a, "end": b} for a, b in f[2]] for f in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [
                batch.column("doc_id"),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.list_(pa.string())),
                pa.array(spans, kind),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "items", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, _FOUND)


def remove_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the passages cut out of ``text``; all rows and columns stay."""
    blocks = blocks_of(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SHARD_BYTES):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            found = find(texts, [b.value for b in blocks])
            kept = [cut(t, f[2]) if f[2] else t for t, f in zip(texts, found, strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(kept, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of the item ids instead of the lists of ``contamination``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
