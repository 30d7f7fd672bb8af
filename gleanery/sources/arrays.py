"""JSON array files read by many tasks.

A file is cut into ranges of bytes that know nothing of each other: a range may begin inside an
object, a string, or behind a backslash. In a first pass every range says what it does to the state of
a lexer, whatever that state is at its beginning: whether it changes between inside and outside
of a string, and by how much the nesting grows, for either case. These changes are composed in order, which gives each
range the state it begins with. In a second pass it then finds the objects that begin in it; the pieces
of those that go on in later ranges are put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.session import materialise
from gleanery.sources.numbering import FILE, PART, POSITION

# Ranges are read as lines that end with this sign. It is no part of a longer character, and
# a backslash in front of it is no escape that JSON knows.
_CUT = "}"
_QUOTE, _COMMA, _OPEN, _CLOSE = (ord(c) for c in '",[]')
_CHUNK = 4 << 20

WHOLE, BEGINS, GOES_ON = 0, 1, 2

_KIND = np.zeros(256, np.int8)
_KIND[[ord("{"), ord("[")]] = 1
_KIND[[ord("}"), ord("]")]] = -1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True


def _quotes(data: bytes) -> np.ndarray:
    """Which bytes are quotes that begin or end a string; a backslash escapes what follows."""
    if b"\\" in data:
        data = data.replace(b"\\\\", b"  ").replace(b'\\"', b"  ")
    return np.frombuffer(data, np.uint8) == _QUOTE


def _inside(quotes: np.ndarray, inside: int) -> np.ndarray:
    """Whether each byte is inside a string, or is the quote that begins one."""
    return ((np.cumsum(quotes, dtype=np.uint8) & 1) ^ inside).astype(bool)


def change(data: bytes) -> tuple[int, int, int]:
    """What a piece of text does to the state: whether the number of quotes is odd, and the nesting it adds from outside and inside a string."""
    quotes = _quotes(data)
    kinds = _KIND[np.frombuffer(data, np.uint8)]
    inside = _inside(quotes, 0)
    return int(quotes.sum() & 1), int(kinds[~inside].sum()), int(kinds[inside].sum())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes]]:
    """The columns but the text of each part of the input, and its text in chunks of whole lines."""
    names: list[str] = []
    key, held, size = None, [], 0
    for batch in batches:
        names = [n for n in batch.schema.names if n != "line"]
        places = list(zip(*(batch.column(n).to_pylist() for n in names), strict=True))
        for place, line in zip(places, batch.column("line").to_pylist(), strict=True):
            if held and (place != key or size > _CHUNK):
                yield dict(zip(names, key, strict=True)), _CUT.encode().join([*held, b""])
                held, size = [], 0
            key = place
            held.append(line)
            size += len(line) + 1
    if held:
        yield dict(zip(names, key, strict=True)), _CUT.encode().join([*held, b""])


_CHANGES = f"{FILE} string, {PART} long, odd long, outside long, inside long"
_CHANGE_KINDS = pa.schema([(FILE, pa.string()), *[(n, pa.int64()) for n in (PART, "odd", "outside", "inside")]])


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range."""
    key, state = None, [0, 0, 0]

    def made() -> pa.RecordBatch:
        row = {FILE: key[FILE], PART: key[PART], "odd": state[0], "outside": state[1], "inside": state[2]}
        return pa.RecordBatch.from_pylist([row], schema=_CHANGE_KINDS)

    for place, data in _chunks(batches):
        if key is not None and place != key:
            yield made()
            state = [0, 0, 0]
        key = place
        odd, outside, inside = change(data)
        # entered outside a string, this chunk is reached inside one if the quotes so far are odd
        state = [state[0] ^ odd, state[1] + (inside if state[0] else outside), state[2] + (outside if state[0] else inside)]
    if key is not None:
        yield made()


class _Cutter:
    """Finds the objects of a range, chunk by chunk. Pieces of text are (kind, position in the range, text)."""

    def __init__(self, inside: int, depth: int):
        self.inside, self.depth = inside, depth
        self.objects, self.commas, self.arrays = 0, 0, 0
        self.wrong = ""
        self.held: list[bytes] = []  # of the object that is not complete yet

    def cut(self, data: bytes) -> Iterator[tuple[int, int | None, bytes]]:
        codes, quotes = np.frombuffer(data, np.uint8), _quotes(data)
        inside = _inside(quotes, self.inside)
        kinds = np.where(inside, 0, _KIND[codes]).astype(np.int64)
        after = self.depth + np.cumsum(kinds)
        before = after - kinds
        starts, ends = np.flatnonzero((before == 1) & (kinds == 1)), np.flatnonzero((before == 2) & (after == 1))
        self._check(codes, inside | quotes, before, after, starts)
        left = iter(ends.tolist())
        if self.depth > 1:
            end = next(left, None)
            self.held.append(data if end is None else data[: end + 1])
            if end is not None:
                yield from self.rest(WHOLE)
        for start in starts.tolist():
            self.objects += 1
            end = next(left, None)
            if end is None:
                self.held = [data[start:]]
            else:
                yield WHOLE, self.objects - 1, data[start : end + 1]
        self.inside ^= int(quotes.sum() & 1)
        self.depth = int(after[-1])

    def rest(self, kind: int = BEGINS) -> Iterator[tuple[int, int | None, bytes]]:
        """What is held, as a piece of ``kind``, or as the rest of an object that began in an earlier range."""
        if self.held:
            text, self.held = b"".join(self.held), []
            yield (kind, self.objects - 1, text) if self.objects else (GOES_ON, None, text)

    def _check(self, codes: np.ndarray, quoted: np.ndarray, before: np.ndarray, after: np.ndarray, starts: np.ndarray) -> None:
        """Between objects there are commas, one each, and around them one array. The sign that the last line gets although it ends the file is let pass."""
        outer = (before <= 1) & (after <= 1) & ~_SPACE[codes]
        comma = outer & ~quoted & (codes == _COMMA) & (before == 1)
        array = outer & ~quoted & (codes == _OPEN) & (before == 0)
        closes = outer & ~quoted & ((codes == _CLOSE) & (after == 0) | (codes == ord(_CUT)) & (after == -1))
        if (outer & ~(comma | array | closes)).any() or (codes[starts] != ord("{")).any():
            self.wrong = "something that is no object of an array"
        commas = np.flatnonzero(comma)
        if (np.diff(np.searchsorted(commas, starts)) != 1).any():
            self.wrong = "objects that are not separated by one comma"
        self.commas += len(commas)
        self.arrays += int(array.sum())


_PIECES = f"{FILE} string, {PART} long, {POSITION} long, piece int, text string, commas long, arrays long, depth long, wrong string"
_PIECE_KINDS = pa.schema(
    [
        (FILE, pa.string()),
        *[(n, pa.int64()) for n in (PART, POSITION)],
        ("piece", pa.int32()),
        ("text", pa.string()),
        *[(n, pa.int64()) for n in ("commas", "arrays", "depth")],
        ("wrong", pa.string()),
    ]
)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, cutter = None, None

    def rows(found) -> list[dict]:
        return [{FILE: place[FILE], PART: place[PART], POSITION: n, "piece": p, "text": t.decode("utf-8", "replace")} for p, n, t in found]

    def closing() -> pa.RecordBatch:
        # a row without text sums up the range
        last = {FILE: place[FILE], PART: place[PART], "commas": cutter.commas, "arrays": cutter.arrays, "depth": cutter.depth, "wrong": cutter.wrong}
        return pa.RecordBatch.from_pylist([*rows(cutter.rest()), last], schema=_PIECE_KINDS)

    for now, data in _chunks(batches):
        if now != place:
            if cutter is not None:
                yield closing()
            place, cutter = now, _Cutter(now["in_string"], now["depth"])
        yield pa.RecordBatch.from_pylist(rows(cutter.cut(data)), schema=_PIECE_KINDS)
    if cutter is not None:
        yield closing()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The text of the files, cut behind every closing brace; the cuts themselves are left out."""
    read = spark.read.option("lineSep", _CUT).text(path)
    return read.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(PART), F.col("value").cast("binary").alias("line"))


def _entries(changes: DataFrame) -> DataFrame:
    """The state that each range begins with: in_string, depth."""
    order = Window.partitionBy(FILE).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    entered = changes.withColumn("in_string", (F.coalesce(F.sum("odd").over(order), F.lit(0)) % 2).cast("int"))
    grown = F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("outside"))
    depths = entered.withColumn("grown", grown).withColumn("depth", F.coalesce(F.sum("grown").over(order), F.lit(0)))
    return depths.select(FILE, PART, "in_string", "depth", "odd", "grown")


@contextmanager
def _same_ranges(spark: SparkSession) -> Iterator[None]:
    """Both passes cut the files alike, even if executors come or go in between."""
    name = "spark.sql.files.minPartitionNum"
    given = spark.conf.get(name, None)
    spark.conf.set(name, given or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, given)


def _require_arrays(entries: DataFrame, pieces: DataFrame) -> None:
    """Raise unless every file is one array of objects; at most one row comes to the driver."""
    ends = entries.groupBy(FILE).agg((F.sum("odd") % 2).alias("open"), F.sum("grown").alias("grown"), F.count("*").alias("ranges"))
    found = pieces.groupBy(FILE).agg(
        F.count_if(F.col("piece").isin(WHOLE, BEGINS)).alias("objects"),
        F.sum("commas").alias("commas"),
        F.sum("arrays").alias("arrays"),
        F.count("wrong").alias("cut"),
        F.max("wrong").alias("wrong"),
    )
    # the sign that is added at the end of a file leaves one level too few
    state = (F.col("open") == 0) & (F.col("grown") == -1) & (F.col("arrays") == 1)
    listed = F.col("commas") == F.greatest(F.col("objects") - 1, F.lit(0))
    right = state & listed & (F.col("wrong") == "") & (F.col("cut") == F.col("ranges"))
    wrong = ends.join(found, FILE, "left").filter(~F.coalesce(right, F.lit(False))).limit(1).collect()
    if wrong:
        raise ValueError(f"no JSON array of objects: {wrong[0][FILE]} {wrong[0].wrong or ''}")
    if entries.isEmpty():
        raise ValueError("no JSON array: the input is empty")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(place, text): every object of the JSON arrays in the files of ``path``, each file one array, as a written table.

    Files are cut like any text (``spark.sql.files.maxPartitionBytes``), so that one file is read by many tasks. Strings may hold any
    sign; objects may be nested and of any length. An empty array has no objects. Raises ValueError for an
    empty file and for anything else than an array of objects, separated by single commas (which are counted across ranges); what is
    inside an object is not looked at. Ranges are summed up in one row each (about 100 bytes for
    ``maxPartitionBytes`` of input), which are broadcast.
    """
    lines = _lines(spark, path)
    with _same_ranges(spark):
        changes = materialise(lines.mapInArrow(_changes, _CHANGES))
        entries = materialise(_entries(changes))
        # a broadcast leaves the lines in order, which no other join does
        entered = lines.join(F.broadcast(entries.select(FILE, PART, "in_string", "depth")), [FILE, PART])
        pieces = materialise(entered.select(FILE, PART, "in_string", "depth", "line").mapInArrow(_cut_batches, _PIECES))
    _require_arrays(entries, pieces)
    whole = pieces.filter(F.col("piece") == WHOLE).select(FILE, PART, POSITION, "text")
    # at most two pieces a range are left: each object is the piece that begins it and what follows up to the next
    begins = F.col("piece") == BEGINS
    order = Window.partitionBy(FILE).orderBy(PART, "piece_order").rowsBetween(Window.unboundedPreceding, 0)
    broken = pieces.filter(F.col("piece").isin(BEGINS, GOES_ON)).withColumn("piece_order", begins.cast("int"))
    named = broken.withColumn("object", F.count_if(begins).over(order))
    joined = named.groupBy(FILE, "object").agg(
        F.min(F.when(begins, F.col(PART))).alias(PART),
        F.min(POSITION).alias(POSITION),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(PART, "text"))), lambda p: p["text"]), "").alias("text"),
    )
    return whole.unionByName(joined.drop("object"))
