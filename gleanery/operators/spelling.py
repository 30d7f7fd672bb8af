"""A dictionary from a corpus without its misspellings.

Two words are neighbours when deleting at most one letter of each makes them equal: one has a letter
more, another one, or one in another place. A spelling far rarer than a neighbour is taken for a slip.
Only the most frequent word of each shortened form matters for that, so that no pairs of words are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.words import alpha_words
from gleanery.session import materialise

# A word needs this share of the records, ...
LEAST_SHARE = 0.0005
# ... two of them at least, ...
LEAST_RECORDS = 2
# ... and no neighbour that is in so many times as many records.
FAR_MORE = 20
# Shorter words have neighbours by chance.
LEAST_LETTERS = 4


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, records): in how many records each word is, in lower case."""
    words = F.array_distinct(F.transform(alpha_words(F.col(text)), F.lower))
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("records"))


def shortened(word):
    """A word and what is left of it without each of its letters."""
    cut = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.left(word, i - 1), F.substr(word, i + 1)))
    return F.array_distinct(F.concat(F.array(word), cut))


def slips(counts: DataFrame, far_more: int = FAR_MORE) -> DataFrame:
    """(word, meant): spellings of ``counts`` (word, records) far rarer than a neighbour, and the most frequent neighbour, the last by name of equals.

    Joined through their shortened forms, of which a word has one more than letters.
    """
    long = counts.filter(F.length("word") >= LEAST_LETTERS)
    forms = materialise(long.select("word", "records", F.explode(shortened(F.col("word"))).alias("form")))
    top = forms.groupBy("form").agg(F.max(F.struct("records", "word")).alias("top"), F.count("*").alias("n")).filter("n > 1")
    beside = forms.join(top.select("form", "top"), "form").filter(F.col("top.records") >= far_more * F.col("records"))
    return beside.groupBy("word").agg(F.max("top").alias("top")).select("word", F.col("top.word").alias("meant"))


def clean_dictionary(df: DataFrame, text: str = "text", least_share: float = LEAST_SHARE, far_more: int = FAR_MORE) -> DataFrame:
    """(word, records): the words of a corpus (text), but for rare ones and slips.

    All limits are relative to the number of records, so that a corpus and many copies of it
    have the same dictionary.
    """
    counts = materialise(word_counts(df, text))
    records = df.count()
    frequent = (F.col("records") >= F.lit(least_share) * F.lit(records)) & (F.col("records") >= LEAST_RECORDS)
    return counts.filter(frequent).join(slips(counts, far_more), "word", "left_anti")
