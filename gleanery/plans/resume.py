"""Intermediate tables that a rerun of a job takes up.

A table's folder is named by what went into it: the input files with their sizes and times, the parameters
and the tables before it. A rerun with the same inputs and parameters reads the tables that are
complete and goes on from there; anything else has another name and is computed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.session import list_files, path_exists, remove_path

# Part of every name: a change of the code that changes results raises it.
VERSION = 1


def fingerprint(*facts) -> str:
    return hashlib.sha256(json.dumps([VERSION, *facts], sort_keys=True, default=str).encode()).hexdigest()[:20]


def input_facts(spark: SparkSession, path: str) -> list:
    """Names, sizes and times of the files below ``path``."""
    return list_files(spark, path)


def object_facts(thing) -> list:
    """What a detector or another set of parameters is: its type, its plain values, its expressions, and the files and plans of its tables."""
    facts = [type(thing).__module__, type(thing).__qualname__]
    for name, value in sorted(vars(thing).items()):
        if isinstance(value, DataFrame):
            spark = value.sparkSession
            facts.append([name, value.semanticHash(), sorted(f for p in value.inputFiles() for f in list_files(spark, p))])
        elif callable(value):
            code = getattr(value, "__code__", None)
            facts.append([name, value.__module__, value.__qualname__, code and [code.co_code.hex(), repr(code.co_consts), repr(code.co_names)]])
        else:
            facts.append([name, repr(value)])
    return facts


class Stages:
    """Tables below ``folder``, which all executors share and which outlives the job. One run at a time.

    ``facts`` are those of the whole run. A table is complete when its marker is there, which Spark writes last.
    """

    def __init__(self, spark: SparkSession, folder: str, *facts):
        self.spark, self.folder, self.base = spark, folder.rstrip("/"), fingerprint(*facts)
        self.manifest: dict[str, dict] = {}
        self.computed: list[str] = []

    def table(self, name: str, make: Callable[[], DataFrame], *facts) -> DataFrame:
        """The table ``name``: read if it is complete, else made and written. What it is made of is the run's facts and its own."""
        path = f"{self.folder}/{name}-{fingerprint(self.base, name, facts)}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
            self.computed.append(name)
        self.manifest[name] = {"path": path, "facts": json.loads(json.dumps(facts, default=str))}
        return self.spark.read.parquet(path)

    def finish(self) -> None:
        """Write the manifest of this run and remove the tables of others."""
        rows = [(name, m["path"].rsplit("/", 1)[1], json.dumps(m["facts"])) for name, m in sorted(self.manifest.items())]
        frame = self.spark.createDataFrame(rows, "stage string, folder string, facts string")
        frame.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest")
        kept = {folder for _, folder, _ in rows} | {"manifest"}
        for path in list_files(self.spark, self.folder, folders=True):
            if path.rstrip("/").rsplit("/", 1)[1] not in kept:
                remove_path(self.spark, path)
