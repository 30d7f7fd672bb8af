"""Chat formatting in budgeted windows.

The turns of a conversation get token prefix sums. Spans of whole turns are cut where
the prefix sum passes a multiple of ``span``; every span is a window of its own, led by
the conversation's system turn and the last turns before the span, as far as they fit
in ``history`` tokens. Each turn is new in exactly one window; only the assistant texts
that are new there are under the loss mask.

Template: ``<turn>ROLE\\nTEXT</turn>\\n``. In texts and roles a backslash becomes
``\\b`` and ``<`` becomes ``\\l``, in roles a line feed becomes ``\\n``, so that marks
cannot occur inside and the texts come back whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import materialise

# Fixed values of the template.
OPEN = "<turn>"
CLOSE = "</turn>\n"
SYSTEM = "system"
ASSISTANT = "assistant"

# Turns of one conversation whose prefix sums are made in one task; the
# sums of these pieces are then summed per conversation.
PIECE = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: every backslash opens an escape, so the order of replacing is safe."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def estimated_tokens(text: Column) -> Column:
    """A token for every four bytes, rounded up."""
    return F.ceil(F.octet_length(text) / 4)


def place(turns: DataFrame, span: int, tokens=estimated_tokens) -> DataFrame:
    """Give each turn its position, its prefix sums and the key of its window.

    A window key orders the windows of a conversation: the turns longer than a span so
    far, whether the window is behind the last of them, and the span. A long turn
    is a window by itself.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = turns.select(
        F.struct("conv_id").alias("conv"),  # a struct, so that null is a conversation like any other
        "turn",
        F.coalesce(F.floor(F.col("turn") / PIECE), F.lit(-(2**62))).alias("piece"),
        role.alias("role"),
        text.alias("text"),
        F.concat(F.lit(OPEN), _escape_role(role), F.lit("\n"), escape(text), F.lit(CLOSE)).alias("marked"),
    )
    said = said.withColumn("tokens", tokens(F.col("marked"))).withColumn("long", (F.col("tokens") > span).cast("long"))
    whole = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = said.groupBy("conv", "piece").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.sum("long").alias("l"))
    before = pieces.select(
        "conv", "piece", *[F.coalesce(F.sum(c).over(whole), F.lit(0)).alias(f"{c}_before") for c in ("n", "t", "l")]
    )
    inside = Window.partitionBy("conv", "piece").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        said.withColumn("nth", F.count(F.lit(1)).over(inside))
        .withColumn("upto", F.sum("tokens").over(inside))
        .withColumn("longs", F.sum("long").over(inside))
        .join(before, ["conv", "piece"])
    )
    position, end = F.col("nth") + F.col("n_before"), F.col("upto") + F.col("t_before")
    key = F.struct(
        (F.col("longs") + F.col("l_before")).alias("longs"), (1 - F.col("long")).alias("after"), F.floor((end - 1) / span).alias("span")
    )
    return placed.select(
        "conv",
        "role",
        "marked",
        "tokens",
        position.alias("position"),
        (end - F.col("tokens")).alias("start"),
        end.alias("end"),
        key.alias("key"),
        ((position == 1) & (F.col("role") == SYSTEM)).alias("leads"),
    )


def format_windows(turns: DataFrame, span: int = 768, history: int = 256, tokens=estimated_tokens) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text): one row per window.

    A window holds at most 2 * ``span`` + ``history`` tokens and the system turn,
    unless a single turn is longer than ``span``; no turn is cut. Columns: conv_id,
    first_turn (position of its first new turn, from 1), n_context (repeated
    turns in front), text, loss (start and end of each masked-in text, in code points
    of ``text``), n_tokens.

    Turns are ordered by turn, role and text, a null turn first; repeated rows are
    turns of their own. A null role or text is empty; a null conv_id is a
    conversation. An empty table has no windows. The placed turns are written once
    as a scratch table when this is called. A conversation of any length is spread
    over many tasks.
    """
    placed = materialise(place(turns, span, tokens))
    windows = placed.groupBy("conv", "key").agg(F.min("start").alias("first_start"), F.min("position").alias("first_turn"))
    new = placed.select("conv", "key", F.lit(2).alias("kind"), "position", "role", "marked", "tokens")

    # A turn is history for windows that start between its end and its start + history;
    # both sides are dealt by stretches of that length.
    cell = F.explode(F.sequence(F.floor(F.col("end") / history), F.floor((F.col("start") + history) / history)))
    past = placed.filter(~F.col("leads") & (F.col("tokens") <= history)).withColumn("cell", cell).drop("key")
    starts = windows.select("conv", "key", "first_start", F.floor(F.col("first_start") / history).alias("cell"))
    repeated = (
        past.join(starts, ["conv", "cell"])
        .filter(F.col("first_start").between(F.col("end"), F.col("start") + history))
        .select("conv", "key", F.lit(1).alias("kind"), "position", "role", "marked", "tokens")
    )
    system = placed.filter("leads").select("conv", F.lit(0).alias("kind"), "position", "role", "marked", "tokens")
    retained = windows.filter("first_turn > 1").select("conv", "key").join(system, "conv")
    members = new.unionByName(repeated).unionByName(retained)

    grouped = members.groupBy("conv", "key").agg(
        F.array_sort(F.collect_list(F.struct("kind", "position", "role", "marked"))).alias("turns"), F.sum("tokens").alias("n_tokens")
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, turn: Column) -> Column:
        end = acc["at"] + F.length(turn["marked"])
        text = F.struct(
            (acc["at"] + len(OPEN) + F.length(_escape_role(turn["role"])) + 1).alias("start"), (end - len(CLOSE)).alias("end")
        )
        masked_in = (turn["kind"] == 2) & (turn["role"] == ASSISTANT)
        return F.struct(end.alias("at"), F.when(masked_in, F.concat(acc["loss"], F.array(text))).otherwise(acc["loss"]).alias("loss"))

    loss = F.aggregate("turns", F.struct(F.lit(0).alias("at"), empty.alias("loss")), step, lambda acc: acc["loss"])
    fresh = F.filter("turns", lambda t: t["kind"] == 2)
    return grouped.select(
        F.col("conv.conv_id").alias("conv_id"),
        F.array_min(F.transform(fresh, lambda t: t["position"])).alias("first_turn"),
        (F.size("turns") - F.size(fresh)).alias("n_context"),
        F.array_join(F.transform("turns", lambda t: t["marked"]), "").alias("text"),
        loss.alias("loss"),
        "n_tokens",
    )


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted window, unescaped."""
    marked = F.filter(F.split(text, CLOSE), lambda t: t != "")

    def parts(turn: Column) -> Column:
        role = F.substring_index(turn, "\n", 1)
        body = F.substring(turn, F.length(role) + 2, F.length(turn))
        return F.struct(_unescape_role(F.substring(role, len(OPEN) + 1, F.length(role))).alias("role"), unescape(body).alias("text"))

    return F.transform(marked, parts)


def read_loss(text: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"])))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, what its windows hold: every turn once and the text under the mask.

    A digest is over a whole conversation, so here, and only here, its texts meet in one row.
    """
    turns = read_turns(F.col("text"))
    new = F.slice(turns, F.col("n_context") + 1, F.size(turns))
    said = F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = windows.select(
        "conv_id",
        F.struct("first_turn", said.alias("said"), F.array_join(read_loss(F.col("text"), F.col("loss")), "").alias("loss")).alias("part"),
        F.size(new).alias("n"),
        F.length("text").alias("chars"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list("part")).alias("parts"), F.sum("chars").alias("formatted_chars")
    )
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["said"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
