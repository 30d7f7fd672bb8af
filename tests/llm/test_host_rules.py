"""Quality rules on rows whose counts are known, and against a plain count."""

import random
import re

from gleanery.llm import host_rules

DOCS = "doc_id long, source string, text string, words string, n long"  # two names that the operator uses itself


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {q for at in places.values() if len(at) > 1 for p in at for q in range(p, p + 8)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
    n, repeats = len(words), len(covered)
    failed = n < 20 or 100 * repeats > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeats, failed)


def judged(spark, rows):
    return host_rules.judge(spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)).collect()


def test_counts_against_a_plain_count(spark):
    r = random.Random(3)
    rows = []
    for i in range(150):
        words = [r.choice(["a", "b", "#c", "é", "日本", "x|y", "\x1c", "z*"]) for _ in range(r.choice([0, 1, 19, 20, 30, 90]))]
        part = words[:12] * r.choice([0, 1, 2])
        rows.append((i, f"host{i % 7}", "".join(w + r.choice([" ", "\n", " \t", "\r\n"]) for w in words + part)))
    rows += [(200, None, None), (None, "host1", ""), (201, "", " \n\n"), (202, "h", "same words " * 30_000), (5, *rows[5][1:])]
    found = [(x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in judged(spark, rows)]
    assert sorted(found, key=str) == sorted(((i, *plain(t)) for i, _, t in rows), key=str)


def good(i):
    return " ".join(f"w{i}x{k}" for k in range(30))


def test_hosts(spark):
    rows = [(i, "bad", good(i) if i % 5 == 0 else "short") for i in range(200)]
    rows += [(1000 + i, f"fine{i % 20}", good(i) if i % 40 else "short") for i in range(400)]
    rows += [(5000, "one", "short"), (5001, None, good(1))]
    kept = {x.doc_id: x.kept for x in judged(spark, rows)}
    assert not any(kept[i] for i in range(200))  # its host fails, so good documents go as well
    assert all(kept[1000 + i] == bool(i % 40) for i in range(400)) and kept[5001]
    # a host with a single failure is drawn to the mean of all documents
    mean, strength = prior(spark, [(10, 5), (10, 1), (1, 1)])
    assert mean == 7 / 21 and strength >= 1 and (1 + mean * strength) / (1 + strength) < 1


def prior(spark, counts):
    return host_rules.beta_prior(spark.createDataFrame([(f"h{i}", *c) for i, c in enumerate(counts)], "source string, n long, failures long"))


def test_prior_of_simulated_hosts(spark):
    """Hosts that fail alike have a strong prior however small they are; of hosts that differ the strength comes back."""
    r = random.Random(7)

    def fails(n, rate):
        return n, sum(r.random() < rate for _ in range(n))

    mean, strength = prior(spark, [fails(3, 0.3) for _ in range(300)] + [fails(3000, 0.3)])
    assert abs(mean - 0.3) < 0.03 and strength > 15
    for true in (2, 10, 40):
        found = [prior(spark, [fails(r.choice([3, 20, 60]), r.betavariate(0.3 * true, 0.7 * true)) for _ in range(600)])[1] for _ in range(2)]
        assert all(0.6 * true < f < 1.7 * true for f in found)


def test_empty_table_and_hosts_that_agree(spark):
    assert judged(spark, []) == []
    assert all(x.kept for x in judged(spark, [(i, f"h{i}", good(i)) for i in range(3)]))
    assert not any(x.kept for x in judged(spark, [(i, f"h{i}", "short") for i in range(3)]))
