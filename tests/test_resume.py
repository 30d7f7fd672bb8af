"""Runs that break off at every stage against a run that does not."""

import json

import pytest
from pyspark.sql import DataFrame

from gleanery.operators.detectors import EntityDetector, LanguageDetector, number_detector
from gleanery.plans import resume
from gleanery.plans.curate import curate
from gleanery.schema import RECORD_COLUMNS

ROWS = [
    dict.fromkeys(RECORD_COLUMNS, "x")
    | {"question": f"the boat {'qvist ' * (i % 2)}left Cape {chr(65 + i)}lder {i}", "value": "$200", "round": "Jeopardy!", "show_number": "1"}
    for i in range(9)
]
STAGES = ["raw", "judged", "hits-numbers", "picked-numbers", "vocabulary-non_english", "unknown-non_english", "hits-non_english", "picked-non_english",
          "frequencies-proper_nouns", "hits-proper_nouns", "picked-proper_nouns"]


class Lost(Exception):
    pass


@pytest.fixture
def run(spark, tmp_path, monkeypatch):
    source = tmp_path / "in.jsonl"
    source.write_text("\n".join(json.dumps(r) for r in ROWS))
    dictionary = spark.createDataFrame([(w,) for w in "the boat left".split()], "word string")
    dictionary.write.parquet(str(tmp_path / "words"))
    made = []

    def call(stop=None, **options):
        """The stages that were computed; the run is lost once ``stop`` of them are."""
        made.clear()
        table = resume.Stages.table

        def counted(self, name, make, *facts):
            found = table(self, name, make, *facts)
            if self.computed and self.computed[-1] == name and name not in made:
                made.append(name)
                if len(made) == stop:
                    raise Lost
            return found

        with monkeypatch.context() as m:
            m.setattr(resume.Stages, "table", counted)
            words = spark.read.parquet(str(tmp_path / "words"))
            detectors = [number_detector(), LanguageDetector(words), EntityDetector(options.pop("threshold", 3))]
            curate(spark, str(source), str(tmp_path / "out"), "jsonl", size=options.pop("size", 4), detectors=detectors, resume=str(tmp_path / "stages"))
        return list(made)

    call.source, call.folder, call.out = source, tmp_path / "stages", tmp_path / "out"
    return call


def outputs(spark, out):
    found = {}
    for part in ("cleaned", "subsets/numbers", "subsets/non_english", "subsets/proper_nouns", "report/run"):
        rows = spark.read.json(f"{out}/{part}").drop("generation_timestamp").collect()
        found[part] = sorted(str(r) for r in rows if "time" not in str(r) and "speed" not in str(r))
    return found


def test_lost_after_every_stage(spark, run):
    whole = run()
    assert whole == STAGES
    want = outputs(spark, run.out)
    resume.remove_path(spark, str(run.folder))
    resume.remove_path(spark, str(run.out))
    made = []
    lost = 0
    for stop in (1, 4, 3):  # so many stages are added before it breaks off
        with pytest.raises(Lost):
            run(stop=stop)
        lost += stop
    assert run() == STAGES[lost:]
    assert run() == []
    assert outputs(spark, run.out) == want


def test_only_what_changed_is_computed(spark, run):
    run()
    assert run(size=3) == [s for s in STAGES if s.startswith("picked")]
    assert run(size=3, threshold=1) == [s for s in STAGES if "proper" in s]
    run.source.write_text(run.source.read_text() + "\n" + json.dumps(ROWS[0]))
    assert run(size=3, threshold=1) == STAGES
    # tables of earlier runs are gone
    folders = [p.name for p in run.folder.iterdir()]
    assert len(folders) == len(STAGES) + 1 and "manifest" in folders
    manifest = spark.read.json(str(run.folder / "manifest"))
    assert isinstance(manifest, DataFrame) and {r.stage for r in manifest.collect()} == set(STAGES)
