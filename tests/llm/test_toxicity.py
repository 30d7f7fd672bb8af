"""The recurrent network: gradients, held-out accuracy, odd inputs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import gru, toxicity


def loss(p, table, windows, labels):
    logits, kept = gru.forward(p, table, windows, keep=True)
    return float(np.sum(np.logaddexp(0, logits) - labels * logits)), logits, kept


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in gru.initial(5, 4, rng).items()}
    table = rng.standard_normal((9, 5))
    table[0] = 0
    windows, labels = rng.integers(1, 9, (3, 6)), np.array([1.0, 0.0, 1.0])
    windows[1, 4:] = 0
    _, logits, kept = loss(p, table, windows, labels)
    gradients, by_table = gru.backward(p, table, windows, kept, 1 / (1 + np.exp(-logits)) - labels)
    for values, slopes in [*((p[k], gradients[k]) for k in p), (table, by_table)]:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in values.shape)
            if values is table and at[0] == 0:
                continue
            was, step = values[at], 1e-3
            values[at] = was + step
            up = loss(p, table, windows, labels)[0]
            values[at] = was - step
            down = loss(p, table, windows, labels)[0]
            values[at] = was
            assert slopes[at] == pytest.approx((up - down) / 2 / step, rel=0.05, abs=2e-3)


def plain_logit(p, vectors):
    """One window, word by word: two directions, attention, the sum."""

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    sides = []
    for side, order in (("f", vectors), ("b", vectors[::-1])):
        size = len(p[f"u{side}"])
        state, states = np.zeros(size), []
        for x in order:
            given = x @ p[f"w{side}"] + p[f"c{side}"]
            z = sigmoid(given[:size] + state @ p[f"u{side}"][:, :size])
            r = sigmoid(given[size : 2 * size] + state @ p[f"u{side}"][:, size : 2 * size])
            candidate = np.tanh(given[2 * size :] + (r * state) @ p[f"u{side}"][:, 2 * size :])
            state = (1 - z) * state + z * candidate
            states.append(state)
        sides.append(states if side == "f" else states[::-1])
    both = [np.concatenate(pair) for pair in zip(*sides, strict=True)]
    weights = np.exp([np.tanh(s @ p["a"]) @ p["v"] for s in both])
    return sum(w * s for w, s in zip(weights / weights.sum(), both, strict=True)) @ p["o"] + p["d"][0]


def test_scores_against_plain_loops():
    """Every word by itself, every window by itself, in double precision."""
    chance = random.Random(5)
    pool = ["awful", "kind", "river", "é", "x" * 150, "stone", "vile", "and", "日本語の文章です"]
    texts = [" ".join(chance.choice(pool[2:]) for _ in range(60)) + (" vile awful" if i % 3 == 0 else "") for i in range(40)]
    model = toxicity.train(texts, np.array([int(i % 3 == 0) for i in range(40)]), totals=(400, 13))
    p = {k: v.astype(np.float64) for k, v in model.network.items()}

    def vector(word):
        edged = b"<" + word + b">"
        grams = [(edged[i] * 961 + edged[i + 1] * 31 + edged[i + 2]) * 2654435761 >> 7 for i in range(len(edged) - 2)]
        mean = np.mean([model.trigrams[g % toxicity.TRIGRAMS].astype(np.float64) for g in grams], axis=0)
        return np.concatenate([model.words[model.vocabulary.get(word, 0)].astype(np.float64), mean])

    asked = [*texts[:6], "one", "vile " * 100, "", None, "calm " * 31 + "awful"]
    for text, score in zip(asked, model.scores(asked), strict=True):
        words = [vector(w) for w in toxicity.pieces_of(text)]
        starts = range(0, max(1, len(words) - 16), 16) if words else []
        logits = [plain_logit(p, words[a : a + 32]) for a in starts]
        want = 1 / (1 + np.exp(-(np.array([1, max(logits), np.log(len(logits))]) @ model.calibration))) if logits else 0.0
        assert score == pytest.approx(want, abs=2e-4)


@pytest.mark.parametrize("n", [1, 15, 16, 17, 32, 33, 48, 49, 1000])
def test_windows_cover_all_words(n):
    windows = toxicity.windows_of(np.arange(1, n + 1))
    assert set(windows.ravel()) - {0} == set(range(1, n + 1))
    assert all(windows[i, 16] == windows[i + 1, 0] for i in range(len(windows) - 1))


def test_trigrams_are_those_of_each_word():
    words = [b"a", "é".encode(), b"abc", b"z" * 100]
    flat, sizes = toxicity._trigrams(words)
    assert sizes.tolist() == [1, 2, 3, 100]
    alone = [toxicity._trigrams([w])[0].tolist() for w in words]
    assert flat.tolist() == [t for x in alone for t in x]


def test_long_words_are_read_whole():
    words = ["a", "z" * 64, "z" * 200, "漢字" * 300, "é" * 33 + "x", "🙂" * 50, "漢字、" * 40, "a\u00a0" * 50]
    pieces = toxicity.pieces_of(" ".join(words))
    assert b"".join(pieces) == "".join(words).encode() and max(map(len, pieces)) <= toxicity.MOST_BYTES
    assert [p for p in pieces if p.decode()] == pieces  # whole characters
    number, _, windows = toxicity._numbered(["z" * 200])
    assert toxicity._trigrams(list(number))[1].sum() == 64 + 8 and (windows > 0).sum() == 4


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghijklm") for _ in range(r.randrange(2, 9))) for _ in range(1500)]
    bad = ["wretch", "villain", "scoundrel", "knave"]
    rows, labels = [], []
    for i in range(700):
        text = [r.choice(words) for _ in range(r.randrange(20, 200))]
        if i % 4 == 0:
            for _ in range(2):
                text[r.randrange(len(text))] = r.choice(bad)
        rows.append((i, " ".join(text), "x"))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum((r.score >= 0.3) == (r.doc_id % 4 == 0) for r in held)
    assert len(scored) == 700 and right >= 0.97 * len(held)
    # one bad passage at the end of a long text is found, wherever the windows fall
    clean = " ".join(r.text for r in docs.filter("doc_id % 4 = 1").limit(40).collect())
    scores = model.scores([clean + " you wretch and scoundrel" + " the end" * k for k in (0, 5, 20)])
    assert (scores >= 0.3).all()


def test_a_bad_passage_late_in_a_sentence_without_blanks(spark, tables):
    docs, labels = tables
    clean = "これはとても静かな朝の話です。" * 30
    bad = "悪党ならず者卑怯者恥知らず嘘つき。"
    marked = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(clean + bad), "text")).otherwise(F.concat(F.lit(clean), "text")))
    model = toxicity.fit(marked.withColumn("text", F.regexp_replace("text", "wretch|villain|scoundrel|knave", "word")), labels)
    scores = model.scores([clean, clean + bad, clean * 2 + bad + clean])
    assert scores[0] < 0.3 <= scores[1] and scores[2] >= 0.3


def test_defined_cases(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs.limit(200), labels)
    rows = [(None, None), (1, ""), (1, ""), (2, " -!"), (3, "a"), (4, "word " * 100_000), (5, "z" * 600_000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    scored = {(r.doc_id, r.score) for r in toxicity.score(odd, model).collect()}
    assert {(None, 0.0), (1, 0.0), (2, 0.0)} <= scored and all(0 <= s <= 1 for _, s in scored)
    assert toxicity.score(odd.limit(0), model).collect() == []
    assert toxicity.fit(docs, labels.limit(0)) is None and toxicity.fit(docs, labels.selectExpr("doc_id", "quality", "null as toxic")) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}
