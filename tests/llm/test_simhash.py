"""SimHash near-duplicates against all pairs on small tables."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gleanery.llm import components, simhash

DOCS = "doc_id long, text string, fp string, content int"  # two names that the operator uses itself


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Smallest non-null id within reach, by flooding."""
    prints = [plain_fingerprint(t) for _, t in rows]
    near = [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3] for p in prints]
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            seen |= group
            least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
            for j in group:
                out[j] = least
    return [(rows[i][0], f"{prints[i]:016x}", out[i]) for i in range(len(rows))]


def small_corpus(seed):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["Été", "ß", "日本"]
    rows = []
    for i in range(40):
        text = [r.choice(words) for _ in range(r.choice([1, 2, 3, 40, 400]))]
        rows.append((i, " ".join(text)))
        for k in range(r.choice([0, 0, 3, 8])):  # copies with one word changed
            text = list(text)
            text[r.randrange(len(text))] = r.choice(words)
            rows.append((100 + 20 * i + k, "\n".join(text)))
    rows += [(7, None), (8, ""), (8, " \n"), (None, "one two"), (None, None), (3, rows[0][1]), (3, rows[0][1]), (9, "\x1c a b"), (2000, "x " * 70000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = small_corpus(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    found = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(found, key=key) == sorted(plain_components(rows), key=key)


def test_one_row_of_each_component_stays(spark):
    rows = [(n, t) for n, (i, t) in enumerate(small_corpus(3)) if i is not None]
    rows += [*rows[:5], (None, "a text of its own without an id")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(c or -1 for c in {c for _, _, c in plain_components(rows)})


def test_crowded_variants_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 5)
    r = random.Random(5)
    centre = r.getrandbits(63)
    prints = {centre}
    for _ in range(150):
        p = centre
        for _ in range(r.randrange(1, 6)):
            p ^= 1 << r.randrange(63)
        prints.add(p)
    prints |= {r.getrandbits(63) for _ in range(50)}
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    pairs = {tuple(sorted(x)) for x in found.collect()}
    ordered = sorted(prints)
    assert pairs == {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if (a ^ b).bit_count() <= 3}


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_duplicates(empty).collect() == []


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select((299 - F.col("id")).alias("a"), (300 - F.col("id")).alias("b"))
    assert {(r.a, r.b) for r in components.roots(links).collect()} == {(i, 0) for i in range(1, 301)}
