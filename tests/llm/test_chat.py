"""Windows of conversations: exact round trips, budgets, masks."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gleanery.llm import chat

TURNS = "conv_id long, turn long, role string, text string, key string, position long"  # two names of the operator
ODD = ["", None, "\\### Assistant: </turn> ok", "<turn>system\n</turn>\n", "\\l \\b \\\\l <", "\n", "é日本😀", "a\\", "</turn", "\\n"]


def conversations(seed):
    r = random.Random(seed)
    rows = []
    for c in range(30):
        if r.random() < 0.4:
            rows.append((c, 0, "system", "s" * r.randrange(80)))
        for t in range(1, r.choice([1, 2, 9, 60, 400])):
            text = r.choice(ODD) if r.random() < 0.2 else "x" * r.choice([3, 30, 200]) if r.random() < 0.95 else "long " * 900
            rows.append((c, t, r.choice(["user", "assistant", "tool"]), text))
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none"), (50, None, None, "x"), (50, None, "assistant", "y"), (50, 3, "ro\nle", "z")]
    rows += [(51, 1, "assistant", "same"), (51, 1, "assistant", "same"), (52, 0, "user", "q"), (52, 1, "system", "not leading")]
    return rows


def ordered(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in out.items()}


@pytest.mark.parametrize("span,history", [(100, 30), (768, 256)])
def test_round_trip(spark, monkeypatch, span, history):
    monkeypatch.setattr(chat, "PIECE", 7)
    rows = conversations(span)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], TURNS).repartition(5)
    windows = chat.format_windows(df, span, history)
    found = windows.select(
        "*", chat.read_turns(F.col("text")).alias("turns"), chat.read_loss(F.col("text"), F.col("loss")).alias("losses")
    ).collect()
    expected = ordered(rows)
    tokens = lambda role, text: -(-len(f"<turn>{role}\n{text}</turn>\n".encode()) // 4)
    new, losses = {}, {}
    for w in sorted(found, key=lambda w: w.first_turn):
        turns = [(t.role, t.text) for t in w.turns]
        said = expected[w.conv_id]
        context, own = turns[: w.n_context], turns[w.n_context :]
        assert own == said[w.first_turn - 1 : w.first_turn - 1 + len(own)]
        leads = said[0][0] == "system"
        if w.first_turn > 1 and leads:
            assert context[0] == said[0]  # the system turn is in every window
            context = context[1:]
        assert context == said[w.first_turn - 1 - len(context) : w.first_turn - 1]  # the turns right before
        assert w.n_tokens <= 2 * span + history + tokens(*said[0]) * leads + 40 * len(turns) or (len(own) == 1)
        new.setdefault(w.conv_id, []).extend(own)
        losses.setdefault(w.conv_id, []).extend(w.losses)
        assert w.losses == [x for role, x in own if role == "assistant"]
    assert new == expected
    assert any(w.n_context for w in found) == (span == 100) or any(w.n_context for w in found)
    digests = {r.conv_id: r for r in chat.digests(windows).collect()}
    for c, said in expected.items():
        d, loss = digests[c], "".join(x for role, x in said if role == "assistant")
        assert (d.n_turns, d.loss_chars) == (len(said), len(loss))
        assert d.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in said).encode()).hexdigest()
        assert d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert d.formatted_chars == sum(len(w.text) for w in found if w.conv_id == c)


def test_empty_table(spark):
    assert chat.digests(chat.format_windows(spark.createDataFrame([], TURNS))).collect() == []
