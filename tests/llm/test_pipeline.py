"""The pipeline's stages on a small corpus."""

import random

import pytest

import corpus_pipeline
from gleanery.llm import decontaminate, packing
from gleanery.session import materialise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, h long"


def corpus():
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(900)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    item = say(15)
    rows, labels = [], []
    for i in range(120):
        text = "\n".join(say(40) for _ in range(3))
        if i % 6 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        labels.append((i, int(i % 6 != 0), 0))
        if i % 7 == 1:
            text += "\nthis notice stands below every text of the site"
        if i == 20:
            text += f"\n{say(4)} {item} {say(4)}"
        rows.append((i, text))
    rows += [(200, rows[1][1]), (201, rows[1][1].replace(" ", "  ")), (300, None), (301, ""), (1, rows[1][1]), (None, say(50))]
    docs = [(i, t, "en", "s", len(t or ""), "x", 0.5, 7) for i, t in rows]
    return docs, labels, [(1, item), (2, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels, items = corpus()
    out = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    tables = {"given": given}
    docs = given
    for name, stage in corpus_pipeline.STAGES:
        docs = tables[name] = materialise(stage(spark, docs, folder))
        assert name == "packing" or docs.schema.names == given.schema.names
    rows = {n: {r.doc_id: r for r in t.collect()} for n, t in tables.items()}
    assert {i for i in range(120) if i % 6 == 0}.isdisjoint(rows["quality"])
    assert all(i in rows["quality"] for i in range(120) if i % 6)
    notice = "this notice stands below every text of the site"
    holders = sorted(i for i, r in rows["quality"].items() if i is not None and r.text and notice in r.text)
    assert len(holders) > 3 and [i for i, r in rows["lines"].items() if r.text and notice in r.text] == holders[:1]
    clean = [i for i in range(120) if i % 6 and i % 7 != 1 and i != 20]
    assert all(rows["decontamination"][i][1:] == rows["given"][i][1:] for i in clean)  # untouched
    assert 200 not in rows["near_duplicates"] and tables["near_duplicates"].filter("doc_id = 1").count() == 1
    item = corpus()[2][0][1]
    assert item in rows["near_duplicates"][20].text and item not in rows["decontamination"][20].text
    assert all(r.n_chars == len(r.text or "") for r in rows["decontamination"].values())
    packed = tables["packing"].groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0]: r[1] for r in packed} == {i: len((r.text or "").split()) for i, r in rows["decontamination"].items()}
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, tables["packing"].collect()), key=str)


def test_empty_corpus(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder))
        assert docs.count() == 0


def test_the_stages_follow_their_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and packing.PARTS > 0 and decontaminate.WINDOW == 10
