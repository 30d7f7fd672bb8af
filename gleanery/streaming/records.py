"""Cleaning and flagging a stream of records.

Validation, cleaning and the pattern detectors look at one record at a time, so
the batch expressions run on a stream as they are. Vocabulary and entity counts
need the whole corpus and stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanery.functions import numbers, words
from gleanery.operators.detectors import combined_text
from gleanery.operators.load import normalise
from gleanery.operators.validate import accepted, flag
from gleanery.schema import ID, RECORDS


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Records with a ``record_id`` from JSON lines files as they arrive in a folder."""
    schema = ", ".join(f"{f.name} string" for f in RECORDS) + f", {ID} bigint"
    return spark.readStream.schema(schema).json(folder)


def flagged_records(stream: DataFrame) -> DataFrame:
    """Clean records of a stream with ``has_numbers`` and ``has_non_ascii``."""
    clean = accepted(flag(normalise(stream)))
    text = combined_text(clean, ["question", "answer", "category"])
    return clean.withColumns(
        {
            "has_numbers": numbers.has_number(text),
            "has_non_ascii": words.has_non_ascii(F.concat_ws(" ", "question", "answer")),
        }
    )


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to JSON files; process what is there and stop."""
    writer = df.writeStream.format("json").option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start(path)
