"""Readers for records, tables of texts and word lists."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.language import word_list
from gleanery.operators.load import check_columns, first_rows
from gleanery.schema import ID, RECORD_COLUMNS, RECORDS
from gleanery.session import materialise
from gleanery.sources.arrays import read_objects
from gleanery.sources.numbering import FILE, PART, POSITION, number_rows, place_lines, place_parquet


def check_keys(df: DataFrame) -> None:
    """Raise when a record has no key, or when records share one.

    One pass over the keys; at most one row comes to the driver.
    """
    wrong = df.groupBy(ID).agg(F.count("*").alias("n")).filter(F.col(ID).isNull() | (F.col("n") > 1)).limit(1).collect()
    if wrong:
        key, n = wrong[0]
        raise ValueError(f"{n} records have no {ID}" if key is None else f"{n} records have the {ID} {key}")


def _require(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.globStatus(hadoop_path):
        raise FileNotFoundError(f"File not found: {path}")


def _json_line_columns(spark: SparkSession, path: str) -> list[str]:
    """Which of the expected columns occur in JSON lines, by one pass over all of them."""
    return _present(spark.read.text(path).select(*_has(F.col("value"))))


def _has(text: Column) -> list[Column]:
    """Whether a JSON object has each of the expected columns."""
    keys = F.json_object_keys(text)
    return [F.coalesce(F.array_contains(keys, c), F.lit(False)).alias(f"has_{c}") for c in (ID, *RECORD_COLUMNS)]


def _present(flags: DataFrame) -> list[str]:
    found = flags.agg(*[F.bool_or(f"has_{c}").alias(c) for c in (ID, *RECORD_COLUMNS)]).first()
    return [c for c in (ID, *RECORD_COLUMNS) if found[c]]


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType(([T.StructField(ID, T.LongType())] if ID in columns else []) + RECORDS.fields)


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    # An explicit schema would hide absent columns, so their names are looked up first.
    columns = _json_line_columns(spark, path)
    check_columns(columns)
    reader = spark.read.options(mode="FAILFAST", primitivesAsString=True).schema(_schema(columns))
    return _keyed(reader.json(path), place_lines)


def _read_arrays(spark: SparkSession, path: str) -> DataFrame:
    schema = _schema([ID])
    options = {"mode": "FAILFAST", "primitivesAsString": "true"}
    parsed = F.from_json("text", schema, options)
    objects = read_objects(spark, path)
    rows = materialise(objects.select("*", F.explode(F.array(parsed)).alias("row")).select(FILE, PART, POSITION, "row.*", *_has(F.col("text"))))
    columns = _present(rows)
    check_columns(columns)
    if ID in columns:
        rows = rows.select(ID, *RECORD_COLUMNS)
        check_keys(rows)
        return rows
    return number_rows(rows.select(FILE, PART, POSITION, *RECORD_COLUMNS))


def _read_table(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    check_columns(df.columns)
    return _keyed(df, place_parquet)


def _keyed(df: DataFrame, place: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Records with their own keys, checked, or with their numbers in the input."""
    text = [F.col(c).cast("string") for c in RECORD_COLUMNS]
    if ID in df.columns:
        df = df.select(ID, *text)
        check_keys(df)
        return df
    return number_rows(materialise(place(df).select(FILE, PART, POSITION, *text)))


def read_records(spark: SparkSession, path: str, kind: str = "json", limit: int | None = None) -> DataFrame:
    """Records as seven text columns and a key.

    ``kind`` is ``json`` (files that are an array of objects each, cut into ranges like any text), ``jsonl``
    or ``parquet``. All values are read as text, so ``"0012"`` stays as it is. Records without a key
    (``record_id``) get their number in the input, from 0: by name of the file, then by place in it; the numbered table is written, so that
    keys stay the same however often it is read. ``limit`` takes the first rows by key. Raises
    FileNotFoundError for a missing path and ValueError for malformed input, missing
    columns, and keys that are NULL or not unique.
    """
    _require(spark, path)
    readers = {"json": _read_arrays, "jsonl": _read_lines, "parquet": _read_table}
    if kind not in readers:
        raise ValueError(f"unknown kind: {kind}")
    try:
        df = readers[kind](spark, path)
        return df if limit is None else first_rows(df, limit)
    except (PySparkException, Py4JError) as e:
        raise ValueError(f"Failed to load {kind} data: {e}") from e


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary from a text file with one word per line."""
    _require(spark, path)
    return word_list(spark.read.text(path))
