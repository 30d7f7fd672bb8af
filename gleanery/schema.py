"""The record table: seven text columns and a key."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the record columns, in output order.
RECORD_COLUMNS = ["category", "value", "question", "answer", "round", "show_number", "air_date"]

# Field groups, in the order in which they are validated.
METADATA_FIELDS = ["category", "air_date", "value", "round", "show_number"]
TEXT_FIELDS = ["question", "answer"]

# The rounds a record may belong to.
ROUNDS = ["Jeopardy!", "Double Jeopardy!", "Final Jeopardy!", "Tiebreaker"]

ID = "record_id"

RECORDS = T.StructType([T.StructField(c, T.StringType()) for c in RECORD_COLUMNS])
