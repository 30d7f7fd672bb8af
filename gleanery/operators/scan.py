"""Places in texts where one of many strings may stand, by one pass over the texts.

Every string leaves bits in tables of bounded size, chosen by a hash of its bytes: some for its beginnings of
power-of-two length, some for the whole. At each place of a text the beginnings are looked up, the next one only where the last
one was there, and the whole strings of the lengths between two powers where their beginning was. The hash of any piece of a text
comes from running sums, so that arrays of places are looked up at a time.

No string is missed. Others are found by chance, few as long as the tables are larger than the set, so who asks
compares what was found with the strings themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits for each string, if there is room, and the most and fewest bits of a table as powers of two: 16 MB at most.
_SHARE, _MOST, _FEWEST = 32, 27, 16

# Places that are looked at together, and pairs of a place and a length: arrays that stay in a processor's cache.
WINDOW, _PAIRS = 1 << 16, 1 << 17

# Bytes of the texts whose finds are Python objects at the same time.
_SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_PROBES = tuple(np.uint64(x) for x in (0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

# Tables: of beginnings, of whole strings, of whole strings with their labels.
_BEGINNING, _WHOLE, _LABELLED = range(3)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Sums:
    """Hashes of the pieces of an array of bytes."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        if len(Sums._up) < len(data):
            Sums._up, Sums._down = _powers(_BASE, len(data)), _powers(_INVERSE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * Sums._up[: len(data)], out=self.sums[1:])

    def every(self, n: int, size: int) -> np.ndarray:
        """Of the pieces of one size at the first n places."""
        return (self.sums[size : size + n] - self.sums[:n]) * Sums._down[:n]

    def at(self, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[places]) * Sums._down[places]


def _key(hashes: np.ndarray, salt) -> np.ndarray:
    """Hashes made different by a number or numbers: a size, a label."""
    return hashes ^ (np.asarray(salt).astype(np.uint64) * _MIX)


def _places(keys: np.ndarray, probe: np.uint64, bits: int) -> np.ndarray:
    return ((keys * probe) >> np.uint64(64 - bits)).view(np.int64)


@dataclass
class Strings:
    """What is kept of the strings (``tables`` in bytes), the sizes that occur, in order, and the labels."""

    bits: int
    sizes: np.ndarray
    labels: list[int]
    tables: list[np.ndarray]

    def _in(self, table: int, keys: np.ndarray) -> np.ndarray:
        """Which of the keys are in a table, by their index."""
        kept = None
        for probe in _PROBES:
            at = _places(keys if kept is None else keys[kept], probe, self.bits)
            there = (self.tables[table][at >> 3] >> (at & 7).astype(np.uint8)) & 1
            kept = np.flatnonzero(there) if kept is None else kept[there.view(bool)]
        return kept

    def finds(self, data: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, place, size, label) of what may be a string; row i lies in ``data`` from ``starts[i]`` up to ``starts[i + 1]``."""
        if not len(self.sizes):
            return
        longest, powers = int(self.sizes[-1]), [int(s).bit_length() - 1 for s in self.sizes]
        step, last = max(window, longest), int(starts[-1])
        for a in range(int(starts[0]), last, step):
            b = min(a + step, last)
            sums = Sums(data[a : min(b + longest - 1, last)])
            first, end = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b, "left")
            rows = np.repeat(np.arange(first, end), np.diff(np.clip(starts[first : end + 1], a, b)))
            room = starts[rows + 1] - np.arange(a, b)
            at = None
            for power in range(powers[0], powers[-1] + 1):
                size = 1 << power
                if at is None:
                    at = self._in(_BEGINNING, _key(sums.every(max(0, min(b - a, len(sums.sums) - size)), size), power))
                    at = at[room[at] >= size]
                else:
                    at = at[room[at] >= size]
                    at = at[self._in(_BEGINNING, _key(sums.at(at, at + size), power))]
                if not len(at):
                    break
                sizes = self.sizes[np.searchsorted(self.sizes, size) : np.searchsorted(self.sizes, 2 * size)]
                for i in range(0, len(at) if len(sizes) else 0, some := max(1, _PAIRS // max(1, len(sizes)))):
                    places, lengths = (x.ravel() for x in np.meshgrid(at[i : i + some], sizes, indexing="ij"))
                    fits = room[places] >= lengths
                    places, lengths = places[fits], lengths[fits]
                    keys = _key(sums.at(places, places + lengths), lengths)
                    found = self._in(_WHOLE, keys)
                    places, lengths, keys = places[found], lengths[found], keys[found]
                    for label in self.labels:
                        of = self._in(_LABELLED, _key(keys, label)) if len(self.labels) > 1 else np.arange(len(places))
                        yield rows[places[of]], places[of] + a, lengths[of], np.full(len(of), label)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings, and where each begins and the last one ends; a null is empty."""
    column = column.cast(pa.large_string())
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), starts


def listed(sizes: list[int], values: pa.Array) -> pa.ListArray:
    """Lists of these sizes."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)


def packed(strings: list[bytes]) -> pa.Array:
    """An array of strings from their bytes."""
    ends = np.cumsum([0, *map(len, strings)])
    return pa.StringArray.from_buffers(len(strings), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b"".join(strings)))


def found_in(strings: Strings, column: pa.Array, window: int = WINDOW) -> Iterator[tuple[int, list[bytes], list[dict[tuple[bytes, int], list[int]]]]]:
    """By slices of an array of texts: the first row, the texts, and for each the (string, label) that it may hold with their places, in order."""
    data, starts = flat(column)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(starts, starts[row] + _SLICE_BYTES, "right")) - 1)
        low, raw = int(starts[row]), data[starts[row] : starts[to]].tobytes()
        bounds = (starts[row : to + 1] - low).tolist()
        held: list[dict] = [{} for _ in range(to - row)]
        for found in strings.finds(data[low : starts[to]], starts[row : to + 1] - low, window):
            for r, place, size, label in zip(*(x.tolist() for x in found), strict=True):
                held[r].setdefault((raw[place : place + size], label), []).append(place - bounds[r])
        yield row, [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], held
        row = to


def _words(sizes: np.ndarray, bits: int, labelled: bool):
    """Batches of (string, label) to the words of the tables that hold their bits."""
    least = int(sizes[0]).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat(batch.column("string"))
            sums = Sums(data[starts[0] : starts[-1]])
            at, lengths = starts[:-1] - starts[0], np.diff(starts)
            whole = _key(sums.at(at, at + lengths), lengths)
            keys = {_WHOLE: [whole], _BEGINNING: []}
            if labelled:
                keys[_LABELLED] = [_key(whole, batch.column("label").to_numpy(zero_copy_only=False))]
            for power in range(least, int(lengths.max(initial=1)).bit_length()):
                some = at[lengths >= 1 << power]
                keys[_BEGINNING].append(_key(sums.at(some, some + (1 << power)), power))
            for table, each in keys.items():
                places = np.unique(np.concatenate([_places(k, probe, bits) for k in each for probe in _PROBES] or [at[:0]]))
                words, first = np.unique(places >> 6, return_index=True)
                if len(words):
                    held = np.bitwise_or.reduceat(np.uint64(1) << (places & 63).astype(np.uint64), first).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), table, np.int32)), pa.array(words.astype(np.int32)), pa.array(held)], ["table", "word", "held"])

    return run


def read_strings(strings: DataFrame) -> Strings:
    """Bits of the distinct non-empty strings of a written table (string, label): ``label``, if there, is one of few whole numbers.

    What comes to the driver is bounded by the tables' size and by the number of different lengths.
    """
    strings = strings.filter("string != ''")
    labelled = "label" in strings.columns
    strings = strings.select("string", F.col("label").cast("long") if labelled else F.lit(0).cast("long").alias("label"))
    counts = strings.groupBy(F.octet_length("string").alias("size"), "label").count().collect()
    sizes, labels = np.array(sorted({r.size for r in counts}), np.int64), sorted({r.label for r in counts})
    wanted = _SHARE * sum(r["count"] for r in counts)
    bits = min(_MOST, max(_FEWEST, wanted.bit_length()))
    tables = [np.zeros(1 << bits - 6, np.uint64) for _ in range(3 if len(labels) > 1 else 2)]
    if counts:
        words = strings.mapInArrow(_words(sizes, bits, len(labels) > 1), "table int, word int, held long")
        for batch in words.groupBy("table", "word").agg(F.bit_or("held").alias("held")).toArrow().to_batches():
            kind, word, held = (batch.column(c).to_numpy() for c in ("table", "word", "held"))
            for i, table in enumerate(tables):
                table[word[kind == i]] = held[kind == i].view(np.uint64)
    return Strings(bits, sizes, labels, [t.view(np.uint8) for t in tables])
