"""Repair of the turn structure of conversations by the cheapest edits.

Every turn gets the initial of its role and its fault; no text is needed to choose the edits. The
turns of a conversation are cut into stretches, each searched by itself from every state that it may be
entered in (``audit``); the stretches of a conversation are then joined, and the edits are
dealt back to the turns, which pass by in order, one at a time.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gleanery.llm import audit
from gleanery.llm.common import let, slices
from gleanery.session import materialise

# Fixed values of the contract.
USER, ASSISTANT = "user", "assistant"
_BLANK = " \t\n\x0b\x0c\r"
_LEGAL = ("su", "ua", "au")

# Turn numbers of a stretch.
STRETCH = 256

_SLICE_BYTES = 4 << 20


def _said(turns: DataFrame) -> DataFrame:
    """The turns with null roles and texts as one space, keyed for order; a null conv_id is a conversation."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select(
        F.struct("conv_id").alias("conv"),
        # null turns come first
        F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(2**62))).alias("stretch"),
        F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").cast("long").alias("turn")).alias("at"),
        role.alias("role"),
        text.alias("text"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("same"),
    )


def _fault(text: Column) -> Column:
    """b: blank, t: does not end a sentence, k: neither."""

    def ending(bare: Column) -> Column:
        return F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "k").otherwise("t")

    return let(F.btrim(text, F.lit(_BLANK)), ending)


def _stretches(said: DataFrame) -> DataFrame:
    """(conv, stretch, initials, faults, turns): a row per stretch; ``turns`` are its different turn numbers, null left out."""
    initial = F.substring("role", 1, 1)
    coded = said.select(
        "conv", "stretch", "at", "role", "same", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), _fault(F.col("text")).alias("fault")
    )
    # only what is said more than once is joined back; its first place is one row per conversation and text
    said_often = coded.filter("fault != 'b'").groupBy("conv", "same").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    repeated = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    marked = coded.join(said_often, ["conv", "same"], "left").select("conv", "stretch", F.struct("at", "role", "same", "initial", "fault", repeated.alias("repeated")).alias("row"))
    rows = marked.groupBy("conv", "stretch").agg(F.array_sort(F.collect_list("row")).alias("rows"))

    def fault(row: Column, i: Column, rows: Column) -> Column:
        before = rows[F.greatest(i - 1, F.lit(0))]
        again = (i > 0) & (before["at"] == row["at"]) & (before["same"] == row["same"])
        return F.when((row["fault"] != "b") & (row["repeated"] | again), "d").otherwise(row["fault"])

    faults = let(F.col("rows"), lambda rows: F.array_join(F.transform(rows, lambda r, i: fault(r, i, rows)), ""))
    turns = F.array_distinct(F.filter(F.transform("rows", lambda r: r["at"]["turn"]), lambda t: t.isNotNull()))
    return rows.select("conv", "stretch", F.array_join(F.transform("rows", lambda r: r["initial"]), "").alias("initials"), faults.alias("faults"), turns.alias("turns"))


_PATH = "array<struct<entry:int,behind:int,cost:long,audit:string>>"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the stretches but those that most conversations begin with, which are searched where they are joined."""
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("behind", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in slices(batches, "faults", _SLICE_BYTES):
        found = []
        for stretch, initials, faults in zip(*(batch.column(c).to_pylist() for c in ("stretch", "initials", "faults")), strict=True):
            entries = audit.STATES if stretch != 0 else ()
            found.append(
                [
                    {"entry": e, "behind": b, "cost": p[0], "audit": p[1]}
                    for e in entries
                    for b, p in enumerate(audit.paths(initials, faults, e))
                    if p is not None
                ]
            )
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "paths"])


def _known(initials: str, faults: str, paths: list[dict], entry: int) -> list[tuple[int, str] | None]:
    if not paths:
        return audit.paths(initials, faults, entry)
    found: list[tuple[int, str] | None] = [None] * 4
    for p in paths:
        if p["entry"] == entry:
            found[p["behind"]] = p["cost"], p["audit"]
    return found


def _deal(edits: str, sizes: list[int]) -> list[str]:
    """The edits of each stretch: up to and with that of its last turn; inserts behind the last turn of all are the last stretch's."""
    found, at = [], 0
    for n in sizes:
        start = at
        while n:
            n -= edits[at] != "I"
            at += 1
        found.append(edits[start:at])
    found[-1] += edits[at:]
    return found


def _conversation(stretches: list[dict]) -> dict:
    initials = "".join(s["initials"] for s in stretches)
    faults = "".join(s["faults"] for s in stretches)
    known = [functools.partial(_known, s["initials"], s["faults"], s["paths"]) for s in stretches]
    cost, edits = audit.join(known)
    numbers = [t for s in stretches for t in s["turns"]]
    dealt = _deal(edits, [len(s["initials"]) for s in stretches])
    return {
        "conv": stretches[0]["conv"],
        "gaps": numbers[-1] - numbers[0] + 1 - len(numbers) if numbers else 0,
        "blank": faults.count("b"),
        "duplicate": faults.count("d"),
        "truncated": faults.count("t"),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost,
        "audit": edits,
        "edits": [{"stretch": s["stretch"], "edits": e} for s, e in zip(stretches, dealt, strict=True)],
    }


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of rows of the same conversation."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv"] != row["conv"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its counts and its cheapest edits.

    Columns: conv, a struct of conv_id, which may be null; gaps, the numbers between its first and last turn that are missing; blank,
    duplicate, truncated (turns whose first fault it is); illegal (neighbours whose roles may not follow each
    other); cost and audit, the initials of the edits; edits, those of each stretch.

    Turns are ordered by number, null first, then role, then a hash of role and text; repeated rows are turns
    of their own. Null roles and texts are one space. A role that begins with other letters than
    s, u and a fits nowhere. An empty table gives an empty result. Stretches of one conversation are
    searched in different tasks; joining them needs their initials and audits, some bytes per turn.
    """
    conv = f"conv struct<conv_id:{dict(turns.dtypes)['conv_id']}>"
    columns = f"{conv}, stretch long, initials string, faults string, turns array<long>, paths {_PATH}"
    ordered = _stretches(_said(turns)).mapInArrow(_search, columns).repartition("conv").sortWithinPartitions("conv", "stretch")
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    schema = f"{conv}, {counts}, audit string, edits array<struct<stretch:long,edits:string>>"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_conversation(c) for c in _groups(batches))
        while some := list(itertools.islice(found, 256)):
            yield pa.RecordBatch.from_pylist(some, schema=arrow)

    return materialise(ordered.mapInArrow(run, schema))


def _apply(batches: Iterator[pa.RecordBatch], most: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Repaired turns, from rows in order: the edits of a stretch come before its turns."""
    conv, edits, at, position, last = None, "", 0, 0, ""
    out: list[tuple] = []
    held = 0  # letters in ``out``, and some for each row

    def spoken() -> str:
        return ASSISTANT if last[:1] == "u" else USER

    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            r = dict(zip(names, row, strict=True))
            if r["edits"] is not None:
                if conv != r["conv"]:
                    conv, position, last = r["conv"], 0, ""
                edits, at = r["edits"], 0
            else:
                kept = {"K": r["role"], "R": spoken}.get(edits[at])
                at += 1
                if kept is not None:
                    last = kept() if callable(kept) else kept
                    out.append((conv, position, last, r["text"], edits[at - 1]))
                    held += len(r["text"]) + 100
                    position += 1
            while at < len(edits) and edits[at] == "I":
                last = spoken()
                out.append((conv, position, last, "", "I"))
                held += 100
                position += 1
                at += 1
            if held > most:
                yield _turns(out, batch)
                out, held = [], 0
    if out:
        yield _turns(out, batch)


def _turns(rows: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
    kinds = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["conv", "position", "role", "text", "edit"])


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The turns as ``audits`` (``found``) edits them: conv, position from 0, role, text, edit (K kept, R role changed, I inserted).

    The rows of a conversation are in one partition, in order: each text is handled by itself, so that a
    conversation of any length streams through its task.
    """
    kind = dict(turns.dtypes)["conv_id"]
    rows = _said(turns).withColumn("edits", F.lit(None).cast("string"))
    nothing = {"at": rows.schema["at"].dataType, "role": "string", "text": "string", "same": "string"}
    dealt = found.select("conv", F.inline("edits")).select(
        "conv", "stretch", *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()], "edits"
    )
    # the null place of the edits sorts them before the turns of their stretch
    ordered = rows.unionByName(dealt).repartition("conv").sortWithinPartitions("conv", "stretch", F.col("at").asc_nulls_first(), "role", "same")
    return ordered.select("conv", "role", "text", "edits").mapInArrow(
        _apply, f"conv struct<conv_id:{kind}>, position long, role string, text string, edit string"
    )


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, kind = None, None, None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], kind), pa.array([d for _, d in rows], pa.string())], ["conv", "repaired_sha256"])

    for batch in batches:
        kind, found = batch.schema.field("conv").type, []
        for c, position, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "position", "role", "text")), strict=True):
            if position == 0:
                if digest is not None:
                    found.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
        yield made(found)
    if digest is not None:
        yield made([(conv, digest.hexdigest())])


def digests(turns: DataFrame) -> DataFrame:
    """``audits`` and a hash of the repaired turns, without the edits of the stretches.

    The hash reads the rows of ``repaired`` where they were made, so their order still stands.
    """
    found = audits(turns)
    kind = dict(turns.dtypes)["conv_id"]
    hashed = repaired(turns, found).mapInArrow(_hash, f"conv struct<conv_id:{kind}>, repaired_sha256 string")
    empty = hashlib.sha256().hexdigest()
    return found.drop("edits").join(hashed, "conv", "left").withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty)))


def damage(turns: DataFrame) -> DataFrame:
    """The turns with known faults, dealt by a checksum of conversation and turn: the test bed of the contract."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    dealt = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("deal")).filter("deal != 0")
    spoilt = F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    said = dealt.select("conv_id", "turn", F.when(F.col("deal") == 4, USER).otherwise(F.col("role")).alias("role"), spoilt.alias("text"), F.explode(copies))
    return said.drop("col")
